import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidepool.operators.enrich import dim_lookup, enrich_lookup
from tidepool.operators.order_stats import RunningMedian
from tidepool.operators.median import median_by_key, running_median
from tidepool.operators.topn import recent_keys, top_n_per_window
from tidepool.sources.lookup import table_geocoder


def test_running_median_golden(spark):
    nums = [1, 6, 7, 8, 3, 4, 2, 10]
    df = spark.createDataFrame([("k", i, float(n)) for i, n in enumerate(nums)], "k string, seq long, v double")
    got = [r.median for r in running_median(df, "k", "seq", "v").orderBy("seq").collect()]
    assert got == [1, 3.5, 6, 6.5, 6, 5, 4, 5]


def test_median_by_key(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 2.0), ("b", 3.0)], "k string, v double")
    assert rows(median_by_key(df, "k", "v")) == [("a", 3.0), ("b", 2.5)]


def test_median_by_key_matches_builtin(spark):
    import random
    from tidepool.operators.median import median_by_key_builtin
    rnd = random.Random(9)
    data = [(rnd.choice(["hot"] * 6 + ["a", "b", "c"]), None if rnd.random() < 0.02 else float(rnd.randint(-50, 50)))
            for _ in range(4000)] + [("one", 7.0), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(data, "k string, v double")
    for accuracy in (10, 100, 2000):  # brackets for hot keys, whole ranges for small ones
        assert rows(median_by_key(df, "k", "v", accuracy=accuracy)) == rows(median_by_key_builtin(df, "k", "v"))


def test_median_by_key_nan_and_infinity(spark):
    import random
    from tidepool.operators.median import median_by_key_builtin
    rnd = random.Random(4)
    odd = [float("nan"), float("inf"), float("-inf")]
    data = [(k, rnd.choice(odd) if rnd.random() < share else rnd.random()) for k, share in ((0, .05), (1, .45), (2, 1.0))
            for _ in range(800)] + [(3, float("nan")), (3, 1.0), (3, 2.0), (4, float("nan"))]
    df = spark.createDataFrame(data, "k long, v double")
    shown = lambda d: sorted((r.k, str(r.median)) for r in d.collect())
    for accuracy in (20, 2000):
        assert shown(median_by_key(df, "k", "v", accuracy=accuracy)) == shown(median_by_key_builtin(df, "k", "v"))


def test_recent_keys_golden(spark):
    puts = [("u", "a", 1), ("u", "b", 2), ("u", "b", 3), ("u", "c", 4), ("u", "d", 5)]
    df = spark.createDataFrame([(u, k, v, i) for i, (u, k, v) in enumerate(puts)], "u string, key string, v long, seq long")
    got = {r.key: r.v for r in recent_keys(df, "u", "key", "v", "seq", 3).collect()}
    assert got == {"b": 3, "c": 4, "d": 5}


def test_top_n_ties(spark):
    data = [(100, item, pv) for item, pv in [(5, 3), (4, 3), (9, 7), (1, 1), (2, 3), (8, 2), (7, 3)]]
    df = spark.createDataFrame(data, "window_end long, item_id long, pv long")
    assert [(r[1], r[2]) for r in rows(top_n_per_window(df, 5))] == [(1, 9), (2, 2), (3, 4), (4, 5), (5, 7)]


def test_dim_lookup_miss_and_duplicates(spark):
    facts = spark.createDataFrame([(1, "e1"), (2, "e2"), (3, "e9")], "id long, event_id string")
    dim = spark.createDataFrame([("e1", "login", 1), ("e2", "old", 1), ("e2", "new", 2)],
                                "event_id string, event_name string, version long")
    got = rows(dim_lookup(facts, dim, "event_id", ["event_name"], order_col="version"), "id", "event_name")
    assert got == [(1, "login"), (2, "new"), (3, "")]


def test_enrich_lookup_keeps_rows_and_defaults(spark):
    df = spark.createDataFrame([(1, "Road 12"), (2, "Road 12"), (3, "Bad 7"), (4, None)], "id long, addr string")
    out = {r.id: (r.title, r.lng, r.lat) for r in enrich_lookup(df, "addr", table_geocoder, partitions=2).collect()}
    assert out[1] == out[2] == ("ROAD 12", 100.07, 12.5)
    assert out[3] == ("", 0.0, 0.0) and out[4] == ("", 0.0, 0.0)


def test_enrich_lookup_failing_service(spark):
    def broken(_):
        raise RuntimeError("timeout")
    df = spark.createDataFrame([(1, "x")], "id long, addr string")
    assert enrich_lookup(df, "addr", broken).select("title", "lng", "lat").first() == ("", 0.0, 0.0)
    assert df.select(F.lit(1)).count() == 1


def test_running_median_matches_window_form(spark):
    import random
    from tidepool.operators.median import running_median_window
    rnd = random.Random(11)
    data = [(rnd.choice("abcd"), i, None if i % 97 == 0 else float(rnd.randint(0, 40))) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, seq long, v double")
    a = rows(running_median_window(df, "k", "seq", "v"), "k", "seq", "median")
    b = rows(running_median(df, "k", "seq", "v"), "k", "seq", "median")
    assert a == b


def test_running_median_null_and_large_keys(spark):
    """Keys are never numbers of pandas: a null key is one key, near longs stay apart."""
    data = [(None, i, float(i)) for i in range(1, 6)] + [(9007199254740993, 1, 5.0), (9007199254740992, 2, 1.0)]
    df = spark.createDataFrame(data, "k long, seq long, v double")
    got = {(r.k, r.seq): r.median for r in running_median(df, "k", "seq", "v").collect()}
    assert [got[None, i] for i in range(1, 6)] == [1, 1.5, 2, 2.5, 3]
    assert got[9007199254740993, 1] == 5.0 and got[9007199254740992, 2] == 1.0


@pytest.mark.parametrize("hot_rows, chunk_rows", [(100, 60), (50, 7)])
def test_running_median_of_hot_keys_in_chunks(spark, hot_rows, chunk_rows):
    import random
    import statistics
    rnd = random.Random(3)
    data = [(rnd.choice([None, "a", "a", "a", "hot", "hot", "hot", "hot"]), i * (1 << 21),
             rnd.choice([None, float("nan"), float(rnd.randrange(50)), rnd.random() * 100, -3.0, float(i)])) for i in range(2500)]
    df = spark.createDataFrame(data, "k string, seq long, v double")
    got = {r.seq: r.median for r in running_median(df, "k", "seq", "v", hot_rows=hot_rows, chunk_rows=chunk_rows).collect()}
    seen = {}
    for k, seq, v in data:
        if v is not None and v == v:
            seen.setdefault(k, []).append(v)
        assert got[seq] == (statistics.median(seen[k]) if seen.get(k) else None), seq


def test_running_median_helper_golden_and_property():
    import random
    import statistics
    from collections import Counter
    m = RunningMedian()
    assert [m.add(x) for x in [1, 6, 7, 8, 3, 4, 2, 10]] == [1, 3.5, 6, 6.5, 6, 5, 4, 5]
    rnd = random.Random(5)
    seen, m = [], RunningMedian()
    for i in range(3000):
        x = float(rnd.choice([rnd.randint(0, 5), rnd.random()]))
        seen.append(x)
        assert m.add(x) == statistics.median(seen)
        if i % 500 == 499:  # from values and counts
            m = RunningMedian(sorted(Counter(seen).items()))
        if i == 2000:  # go on from the middle of what was seen only
            inner = sorted(seen)
            low, high = inner[700], inner[-700]
            inner = [v for v in inner if low <= v <= high]
            m = RunningMedian(sorted(Counter(inner).items()), sum(v < low for v in seen), sum(v > high for v in seen))
        if i == 2400:
            m = RunningMedian(sorted(Counter(seen).items()))


def test_count_tree_reads_a_node_per_level():
    """Medians from a tree that is written and read again for each batch; a batch reads few of its nodes."""
    import random
    import statistics
    from tidepool.operators.order_stats import CountTree
    rnd = random.Random(8)
    seen, store, root, made = [], {}, 0, 0

    class Counting(dict):
        reads = 0

        def __getitem__(self, k):
            Counting.reads += 1
            return super().__getitem__(k)

    for batch in range(60):
        tree = CountTree(Counting(store), root, made, width=8)
        Counting.reads = 0
        for _ in range(40 if batch < 59 else 1):
            x = rnd.choice([float(rnd.randint(0, 9)), rnd.random() * 100, -rnd.random()])
            seen.append(x)
            tree.add(x)
        assert tree.median() == statistics.median(seen)
        tree.save()
        store, root, made = dict(tree.store), tree.root, tree.made
    assert made > 150 and Counting.reads < 25
    assert len(CountTree(store, root, made)) == len(seen)


def test_running_median_under_ties_sends_counts(spark):
    """A value that most rows have travels to a later chunk as one pair."""
    import random
    from tidepool.operators import median
    rnd = random.Random(4)
    data = [("k", i, 5.0 if rnd.random() < .9 else rnd.random() * 10) for i in range(20_000)]
    df = spark.createDataFrame(data, "k string, seq long, v double")
    parts = median._chunked(df, "k", "seq", "v", 1000)
    context = parts.where("_kind = 0")
    assert context.agg({"_n": "sum"}).first()[0] > 100_000 and context.count() < 20 * 2500
    got = {r.seq: r.median for r in running_median(df, "k", "seq", "v", hot_rows=100, chunk_rows=1000).collect()}
    m = RunningMedian()
    assert all(got[seq] == m.add(v) for _, seq, v in data)


# Fixture: addresses for the geocoding enrichment (Chinese text).
ADDRESSES = ["湖南省长沙县江背镇特立村中间屋组246号", "湖南省会同县金子岩侗族苗族乡三田村二十二组13号",
             "湖南省长沙县榔梨镇花园村窑坪组115号", "湖南省平江县向家镇黄金村409-1号",
             "湖南省中方县牌楼坳镇站坪村梅子坳村民小组", "湖南省长沙县安沙镇三合村代家老屋组646附1号",
             "湖南省长沙县春华镇花园新村花园组387号", "湖南省长沙县福临镇同心村代家组200号",
             "贵州省普定县坪上乡青坪村坡头组18号", "湖南省湘阴县静河乡地坡村六组",
             "湖南省涟源市七星街镇正里村正里组", "湖南省长沙县星沙镇凉塘路社区众鑫建材市场6栋11号"]


def test_enrich_chinese_addresses(spark):
    import json

    def service(addr):  # echoes the address as title; no location for addresses without a number
        if not any(ch.isdigit() for ch in addr):
            return json.dumps({"status": 0, "result": {"title": addr}}, ensure_ascii=False)
        return json.dumps({"status": 0, "result": {"title": addr, "location": {"lng": 112.9, "lat": 28.2}}},
                          ensure_ascii=False)
    df = spark.createDataFrame(list(enumerate(ADDRESSES + ADDRESSES[:2])), "id long, address string")
    out = {r.id: (r.title, r.lng, r.lat) for r in enrich_lookup(df, "address", service).collect()}
    assert len(out) == 14
    assert out[0] == (ADDRESSES[0], 112.9, 28.2) and out[12] == out[0]
    assert out[4] == ("", 0.0, 0.0) and out[9] == ("", 0.0, 0.0)


def test_hanging_calls_never_exceed_the_bound():
    """1,000 keys of a service that hangs: ten calls alive at most, all keys answered, also those of the next batch."""
    import threading
    import time
    from tidepool.operators.enrich import call_all
    alive, most, free, lock = [0], [0], threading.Event(), threading.Lock()

    def hangs(k):
        with lock:
            alive[0] += 1
            most[0] = max(most[0], alive[0])
        free.wait()
        with lock:
            alive[0] -= 1
        return "late"

    keys = [str(i) for i in range(1000)]
    assert call_all(keys, hangs, 10, 0.01) == dict.fromkeys(keys)
    assert call_all(["a", "b"], lambda k: k, 10, 0.05) == {"a": None, "b": None}  # the calls that hang keep their permits
    assert most[0] == alive[0] == 10
    threading.Timer(0.1, free.set).start()
    assert call_all(["a", "b"], lambda k: k, 10, 5.0) == {"a": "a", "b": "b"}
    time.sleep(0.05)
    assert alive[0] == 0


def test_slow_and_failing_calls():
    import time
    from tidepool.operators.enrich import call_all

    def service(k):
        if k == "bad":
            raise OSError("no")
        time.sleep(0.3 if k == "slow" else 0)
        return k.upper()

    got = call_all(["slow", "bad", *map(str, range(50))], service, 4, 0.1)
    assert got == {"slow": None, "bad": None, **{str(i): str(i) for i in range(50)}}
    assert call_all(["slow"], service, 4, None) == {"slow": "SLOW"}
