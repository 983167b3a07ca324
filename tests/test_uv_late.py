from conftest import ORDER_TRACE, VISITS, rows
from tidepool.functions.parse import parse_orders, parse_visits
from tidepool.operators.late import late_split
from tidepool.operators.uv import daily_uv, daily_uv_cumulative, uv_bitmap, uv_running

ZONE = "Asia/Shanghai"


def _lines(spark, items):
    return spark.createDataFrame([(i, s) for i, s in enumerate(items)], "seq long, line string")


def _visits(spark):
    good, _ = parse_visits(_lines(spark, VISITS), keep=("seq",))
    return good


def test_daily_uv_cumulative_golden(spark):
    got = rows(daily_uv_cumulative(_visits(spark), ZONE), "day", "window_start", "day_uv")
    assert got == [("20211017", 1634447599000, 1), ("20211017", 1634451199000, 1),
                   ("20211017", 1634483599000, 3), ("20211017", 1634486359000, 3),
                   ("20211018", 1634486400000, 1), ("20211018", 1634486459000, 1)]


def test_uv_running_header_variant(spark):
    got = rows(uv_running(_visits(spark), ZONE), "day_start", "uv")
    assert got == [(1634400000000, 1), (1634400000000, 2), (1634400000000, 3), (1634486400000, 1)]


def test_uv_bitmap_equals_distinct(spark):
    import random
    rnd = random.Random(3)
    data = [(i, rnd.choice(["a", "b"]), rnd.randint(0, 200_000), 1634447599000 + rnd.randint(0, 3) * 86400000)
            for i in range(3000)]
    df = spark.createDataFrame(data, "seq long, app_id string, uid long, visit_time long")
    assert rows(uv_bitmap(df, ZONE)) == rows(daily_uv(df, ZONE))


def test_late_split_golden(spark):
    orders, _ = parse_orders(_lines(spark, ORDER_TRACE), keep=("seq",))
    out = late_split(orders, 5000, 0, 0, ZONE, chunk_span=2)
    wins = {r.window_start: r for r in out.where("kind = 'window'").collect()}
    late = out.where("kind = 'late'").collect()
    assert [r.info for r in late] == ["Order(orderId=o3, userId=10, money=20, payTime=1634473763000)"]
    w1 = wins[1634473760000]
    assert w1.money == 60 and w1.n_orders == 3
    assert w1.info == ("WindowInfo=[20211017202920,20211017202925),"
                       "Order(orderId=o1, userId=10, money=10, payTime=1634473761000):"
                       "Order(orderId=o2, userId=10, money=30, payTime=1634473762000):"
                       "Order(orderId=o4, userId=10, money=20, payTime=1634473764000):")
    w2 = wins[1634473765000]
    assert w2.money == 30 and "o6" in w2.info.split("Order")[1] and "o5" in w2.info.split("Order")[2]
    # A bounded input closes every window, so o10's window is emitted too.
    assert wins[1634473770000].money == 10 and len(wins) == 3


def test_late_split_all_in_order_has_no_late(spark):
    orders, _ = parse_orders(_lines(spark, sorted(ORDER_TRACE, key=lambda s: int(s.split(",")[3]))), keep=("seq",))
    assert late_split(orders).where("kind = 'late'").count() == 0


def test_uv_bitmap_exact_for_negative_and_extreme_ids(spark):
    ids = [-70000, -32769, -32768, -1, 0, 1, 32767, 32768, 32769, -1, 5, 5,
           9223372036854775807, -9223372036854775807]
    df = spark.createDataFrame([(i, "a", u, 1634447599000) for i, u in enumerate(ids)],
                               "seq long, app_id string, uid long, visit_time long")
    assert rows(uv_bitmap(df, ZONE), "uv") == rows(daily_uv(df, ZONE), "uv") == [(len(set(ids)),)]
