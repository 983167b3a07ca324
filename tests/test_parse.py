import pytest

from conftest import ORDER_TRACE, rows
from tidepool.functions.bits import narrow_to_int, unsigned_widen
from tidepool.functions.json import geocode_fields
from tidepool.functions.parse import (
    parse_behavior_csv, parse_event_line, parse_int, parse_orders, parse_visits, parse_word_num,
)
from pyspark.sql import functions as F


def _lines(spark, items):
    return spark.createDataFrame([(i, s) for i, s in enumerate(items)], "seq long, line string")


def test_parse_int_rejects_blanks_and_overflow(spark):
    df = spark.createDataFrame([(" 12",), ("12",), ("-3",), ("+4",), ("2147483648",), ("1.0",)], "s string")
    assert [r[0] for r in df.select(parse_int(F.col("s"))).collect()] == [None, 12, -3, 4, None, None]


def test_orders_tolerant(spark):
    good, bad = parse_orders(_lines(spark, ORDER_TRACE + ["o7,x,1,2", "o8,1,2", "o9,1,2,3,extra"]), keep=("seq",))
    assert good.count() == 8  # the trace plus the extra-field line
    assert [r.line for r in bad.orderBy("seq").collect()] == ["o7,x,1,2", "o8,1,2"]


def test_visits_exact_arity(spark):
    good, bad = parse_visits(_lines(spark, ["app1,1001,1634447599000", "app1,1,2,3", "app1,x,2", "app1, 1,2"]))
    assert rows(good, "app_id", "uid", "visit_time") == [("app1", 1001, 1634447599000)]
    assert bad.count() == 3


def test_behavior_csv_strict_fails_on_bad_row(spark):
    ok = parse_behavior_csv(_lines(spark, ["662867,2244074,1575622,pv,100", "1,2,3,pv,4,extra"]))
    assert ok.count() == 2
    with pytest.raises(Exception, match="bad input line"):
        parse_behavior_csv(_lines(spark, ["662867,2244074,1575622,pv"])).collect()


def test_word_num_strict(spark):
    assert rows(parse_word_num(_lines(spark, ["flink,1", "spark,2"])), "word", "num") == [("flink", 1), ("spark", 2)]
    with pytest.raises(Exception):
        parse_word_num(_lines(spark, ["hue,four"])).collect()


def test_event_line_both_time_forms(spark):
    df = parse_event_line(_lines(spark, ["1997-01-01 12:00:00,flink,1", "852120000000,flink,2"]), zone="Asia/Shanghai")
    assert rows(df, "ts_ms", "num") == [(852091200000, 1), (852120000000, 2)]


def test_int_narrow_and_widen(spark):
    df = spark.createDataFrame([(4294967297,), (2147483648,), (-1,)], "x long")
    got = [(r.n, r.w) for r in df.select(narrow_to_int("x").alias("n"), unsigned_widen(narrow_to_int("x")).alias("w")).collect()]
    assert got == [(1, 1), (-2147483648, 2147483648), (-1, 4294967295)]


def test_geocode_json_defaults(spark):
    good = ('{"status":0,"message":"query ok","result":{"title":"T74","location":{"lng":116.30676,"lat":39.98296},'
            '"ad_info":{"adcode":"110108"},"similarity":0.8}}')
    replies = [good, "not json", '{"status":1}', '{"result":{"title":"x"}}', None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(replies)], "i int, r string")
    got = [tuple(r) for r in df.orderBy("i").select(*geocode_fields("r")).collect()]
    assert got[0] == ("T74", 116.30676, 39.98296)
    assert got[1:] == [("", 0.0, 0.0)] * 4


def test_digits_with_a_line_end_are_no_number(spark):
    from tidepool.functions.parse import parse_int, parse_long
    df = spark.createDataFrame([("12",), ("12\r",), ("12\n",), ("+3",), ("",)], "s string")
    got = [(r.i, r.n) for r in df.select(parse_int(F.col("s")).alias("i"), parse_long(F.col("s")).alias("n")).collect()]
    assert got == [(12, 12), (None, None), (None, None), (3, 3), (None, None)]
