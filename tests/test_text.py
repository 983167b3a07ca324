from pyspark.sql import functions as F

from conftest import rows
from tidepool.functions.text import java_split, java_trim_is_empty, text_lines, tokens
from tidepool.operators.wordcount import word_count
from tidepool.sources.files import scan_text

# Fixture: the two-file input directory (second file has a line with leading blanks).
HELLO = "flink spark\nhello world\nflink spark"
HELLO2 = "spark hbase hbase flink flink\n   hbase"


def test_java_split_rules(spark):
    cases = ["a  b ", "", "   ", " a", "a b"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = dict((r.i, list(r.t)) for r in df.select("i", java_split("s", "ws_single").alias("t")).collect())
    assert got == {0: ["a", "", "b"], 1: [""], 2: [], 3: ["", "a"], 4: ["a", "b"]}


def test_java_split_tab_and_vertical_tab(spark):
    df = spark.createDataFrame([("a\tb\x0bc d\t",)], "s string")
    r = df.select(java_split("s", "ws_run").alias("ws"), java_split("s", "space").alias("sp")).first()
    assert list(r.ws) == ["a", "b", "c", "d"]
    assert list(r.sp) == ["a\tb\x0bc", "d\t"]


def _dir(tmp_path):
    d = tmp_path / "input_dir"
    d.mkdir()
    (d / "hello.txt").write_text(HELLO)
    (d / "hello2.txt").write_text(HELLO2)
    return str(d)


def test_word_count_nonblank_on_directory(spark, tmp_path):
    lines = scan_text(spark, _dir(tmp_path))
    got = rows(word_count(lines, "ws_single", drop_blank=True))
    assert got == sorted([("flink", 4), ("spark", 3), ("hbase", 3), ("hello", 1), ("world", 1)])


def test_empty_tokens_single_vs_run(spark, tmp_path):
    lines = scan_text(spark, _dir(tmp_path))
    single = dict(rows(word_count(lines, "ws_single")))
    run = dict(rows(word_count(lines, "ws_run")))
    assert single[""] == 3   # "   hbase" -> "", "", "", "hbase"
    assert run[""] == 1      # "   hbase" -> "", "hbase"


def test_text_lines_trailing_newline_and_cr(spark):
    df = spark.createDataFrame([(1, "a\r\nb\n"), (2, "x\n\ny"), (3, "")], "doc_id long, text string")
    got = rows(text_lines(df))
    assert got == [(1, 0, "a"), (1, 1, "b"), (2, 0, "x"), (2, 1, ""), (2, 2, "y")]


def test_trim_is_empty_matches_java(spark):
    df = spark.createDataFrame([(" \t\x01",), (" a ",), ("",)], "s string")
    assert [r[0] for r in df.select(java_trim_is_empty("s")).collect()] == [True, False, True]


def test_tokens_positions(spark):
    df = spark.createDataFrame([(" a  b",)], "line string")
    got = [(r.pos, r.word) for r in tokens(df, "ws_single").orderBy("pos").collect()]
    assert got == [(0, ""), (1, "a"), (2, ""), (3, "b")]
    assert tokens(df, "ws_single", drop_blank=True).select(F.collect_list("word")).first()[0] == ["a", "b"]


def test_java_trim_keeps_non_breaking_space(spark):
    # Java's trim removes chars <= U+0020 only; U+00A0 makes a token non-blank
    df = spark.createDataFrame([("\u00a0",), (" \u00a0",), (" \x1f",)], "s string")
    assert [r[0] for r in df.select(java_trim_is_empty("s")).collect()] == [False, False, True]
