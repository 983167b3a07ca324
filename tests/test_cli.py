"""Command-line wiring: list, run a batch query, run a streaming job."""

import os

from tidepool.__main__ import main


def test_cli_list_and_run(spark, tmp_path, capsys):
    assert main(["list"]) == 0
    assert "daily_uv_cumulative" in capsys.readouterr().out
    out = tmp_path / "uv"
    assert main(["run", "daily_uv_cumulative", "--tables", "/root/testdata/sf0.001", "--out", str(out)]) == 0
    assert spark.read.parquet(str(out)).count() > 0


def _files(folder, texts):
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"{i}.txt").write_text(text)
        os.utime(folder / f"{i}.txt", (1_600_000_000 + i, 1_600_000_000 + i))
    return str(folder)


def test_cli_stream_count_window(spark, tmp_path):
    """Words split at single spaces, five of a word make a window."""
    src = _files(tmp_path / "in", ["a b a\na\n", "a b\n", "a a\n"])
    out = tmp_path / "cw"
    assert main(["stream", "count_window", "--input", src, "--out", str(out),
                 "--checkpoint", str(tmp_path / "ck"), "--available-now"]) == 0
    assert [tuple(r) for r in spark.read.parquet(str(out)).collect()] == [("a", 0, 5)]


def test_cli_update_mode_writes_all_rows(spark, tmp_path):
    """Running word counts, 60 words: every changed row of every batch is in --out."""
    src = _files(tmp_path / "wc", [" ".join(f"w{i}" for i in range(60)) + "\n", "w1 w2\n"])
    out = tmp_path / "wc-out"
    assert main(["stream", "word_count", "--input", src, "--out", str(out),
                 "--checkpoint", str(tmp_path / "ck2"), "--available-now"]) == 0
    got = spark.read.parquet(str(out))
    assert got.where("batch_id = 0").count() == 60
    assert sorted((r.word, r.cnt) for r in got.where("batch_id = 1").collect()) == [("w1", 2), ("w2", 2)]
    again = _files(tmp_path / "wc2", ["w1 new\n"])  # another query, the same folder: both keep their rows
    assert main(["stream", "word_count", "--input", again, "--out", str(out),
                 "--checkpoint", str(tmp_path / "ck2b"), "--available-now"]) == 0
    got = spark.read.parquet(str(out))
    assert got.select("query_id").distinct().count() == 2 and got.where("batch_id = 0").count() == 62


def test_cli_stream_running_count(spark, tmp_path):
    src = _files(tmp_path / "rc", ["a b a\na\n", "b a\n"])
    out = tmp_path / "rc-out"
    assert main(["stream", "running_count", "--input", src, "--out", str(out),
                 "--checkpoint", str(tmp_path / "ck4"), "--available-now"]) == 0
    got = [(r.word, r.cnt) for r in spark.read.parquet(str(out)).orderBy("seq").collect()]
    assert got == [("a", 1), ("b", 1), ("a", 2), ("a", 3), ("b", 2), ("a", 4)]


def test_cli_late_split_keeps_arrival_order(spark, tmp_path):
    src = _files(tmp_path / "late", ["o1,7,1,1634473761000\no2,7,2,1634473760500\n", "o3,7,4,1634473760000\n", "o4,7,8,1634473999000\n", "o5,7,8,1634473999500\n"])
    out = tmp_path / "late-out"
    assert main(["stream", "late_split", "--input", src, "--out", str(out), "--files-per-batch", "2",
                 "--checkpoint", str(tmp_path / "ck3"), "--available-now"]) == 0
    info = [r.info for r in spark.read.parquet(str(out)).where("kind = 'window' and window_start = 1634473760000").collect()]
    assert len(info) == 1 and [f"orderId=o{i}" in info[0] for i in (1, 2, 3)] == [True] * 3
    assert info[0].index("o1") < info[0].index("o2") < info[0].index("o3")


def test_cli_print_shows_every_row(spark, tmp_path, capsys):
    assert main(["run", "filter_event", "--tables", "/root/testdata/sf0.001", "--format", "print"]) == 0
    import __spark_entry__ as E
    assert len(capsys.readouterr().out.splitlines()) == E.queries()["filter_event"](spark, "/root/testdata/sf0.001").count()
