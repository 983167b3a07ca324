import functools
import os

from pyspark.sql import functions as F

from conftest import rows
from stubs import FileKVClient
from tidepool.sinks import jdbc, kv, text
from tidepool.sources.generator import gen_orders_batch

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _orders(spark, n=2500):
    keys = spark.range(n).withColumnRenamed("id", "k")
    return gen_orders_batch(keys, "k", F.col("k") * 1000)


def test_generator_ranges_and_determinism(spark):
    a = _orders(spark, 500)
    stats = a.agg(F.min("user_id"), F.max("user_id"), F.min("money"), F.max("money"),
                  F.countDistinct("order_id")).first()
    assert tuple(stats) == (1, 4, 1, 100, 500)
    assert rows(a) == rows(_orders(spark, 500))


def test_jdbc_retry_does_not_duplicate(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    df = _orders(spark, 300)
    jdbc.write_batch(df, 0, url, "ORDERS_OUT", DERBY)
    jdbc.write_batch(df, 0, url, "ORDERS_OUT", DERBY)     # a retried micro-batch
    jdbc.write_batch(df.limit(10), 1, url, "ORDERS_OUT", DERBY)
    back = spark.read.jdbc(url, "ORDERS_OUT", properties=DERBY)
    assert rows(back.groupBy("batch_id").count()) == [(0, 300), (1, 10)]


def test_kv_pipelined_chunks_and_ttl(spark, tmp_path):
    root = str(tmp_path / "kv")
    df = _orders(spark, 2500).coalesce(1)
    kv.write_kv(df, "order_id", "money", functools.partial(FileKVClient, root), flush_rows=1000)
    got, sizes = FileKVClient.read_all(root)
    assert sizes == [1000, 1000, 500] and len(got) == 2500
    with open(os.path.join(root, os.listdir(root)[0])) as f:
        assert '"ttl": 172800' in f.readline()


def test_kv_upsert_last_write_wins(spark, tmp_path):
    root = str(tmp_path / "kv2")
    df = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("b", 2, 1)], "word string, cnt long, seq long")
    kv.upsert_batch_writer("word", "cnt", functools.partial(FileKVClient, root), order="seq")(df, 0)
    assert FileKVClient.read_all(root)[0] == {"a": "3", "b": "2"}


def test_kv_hash_upsert_keeps_hashes_apart(spark, tmp_path):
    root = str(tmp_path / "kv3")
    client = functools.partial(FileKVClient, root)
    df = spark.createDataFrame([("a", 1)], "word string, cnt long")
    kv.upsert_batch_writer("word", "cnt", client, hash_name=kv.WORD_COUNT_HASH)(df, 0)
    kv.upsert_batch_writer("word", "cnt", client, hash_name="other")(df.selectExpr("word", "cnt + 1 as cnt"), 0)
    assert FileKVClient.read_all(root)[0] == {f"{kv.WORD_COUNT_HASH}/a": "1", "other/a": "2"}


def test_text_sink_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("flink", 4), ("spark", 3)], "word string, cnt long")
    out = str(tmp_path / "txt")
    text.write_text(df, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["flink,4", "spark,3"]


def test_stream_enrichment_rereads_dimension(spark, tmp_path):
    from tidepool.sources.lookup import jdbc_dimension
    from tidepool.streaming.jobs import enrich_each_batch
    url = f"jdbc:derby:{tmp_path}/dimdb;create=true"
    dim = spark.createDataFrame([("e1", "login", 1)], "event_id string, event_name string, version long")
    dim.write.jdbc(url, "EVENT_DIM", mode="overwrite", properties=DERBY)
    seen = []
    run = enrich_each_batch(lambda s: jdbc_dimension(s, url, "EVENT_DIM", DERBY), "event_id", ["event_name"],
                            lambda df, b: seen.append(rows(df, "event_id", "event_name")), order_col="version")
    facts = spark.createDataFrame([("e1",), ("e2",)], "event_id string")
    run(facts, 0)
    spark.createDataFrame([("e2", "pay", 1)], dim.schema).write.jdbc(url, "EVENT_DIM", mode="append", properties=DERBY)
    run(facts, 1)
    assert seen == [[("e1", "login"), ("e2", "")], [("e1", "login"), ("e2", "pay")]]


def test_rate_generator_stream(spark, tmp_path):
    from tidepool.sources.generator import gen_orders_stream
    from tidepool.streaming.jobs import run_to_memory
    import time
    q = run_to_memory(gen_orders_stream(spark, 5, micro_batch=True), "gen", checkpoint=str(tmp_path / "g"))
    deadline = time.time() + 60  # the source is unbounded: stop after the first batches
    while time.time() < deadline and spark.table("gen").count() < 5:
        time.sleep(0.5)
    q.stop()
    out = spark.table("gen")
    assert out.count() >= 5
    assert out.where("user_id < 1 OR user_id > 4 OR money < 1 OR money > 100").count() == 0


def _to_files(folder):
    def open_out(part):
        return open(os.path.join(folder, f"part-{part}-{os.getpid()}"), "a", encoding="utf-8")
    return open_out


def _printed(folder):
    return [line for f in sorted(os.listdir(folder)) for line in open(os.path.join(folder, f), encoding="utf-8").read().splitlines()]


def test_printer_prints_every_row(spark, tmp_path):
    text.labelled_printer("result", _to_files(str(tmp_path)))(spark.range(0, 500, 1, 4), 0)
    lines = _printed(str(tmp_path))
    assert len(lines) == 500 and {line.split("> ")[0] for line in lines} == {f"result:{i}" for i in range(4)}


def test_watermark_and_context_printer(spark, tmp_path):
    src, outs = tmp_path / "wm", tmp_path / "printed"
    src.mkdir(), outs.mkdir()
    for i, at in enumerate((1634473761000, 1634473766000, 1634473767000)):
        (src / f"{i}.txt").write_text(f"{at}\n")
        os.utime(src / f"{i}.txt", (1_600_000_000 + i, 1_600_000_000 + i))
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(src))
    ev = lines.select(F.timestamp_millis(F.col("value").cast("long")).alias("ts"), F.col("value").cast("long").alias("ms")).withWatermark("ts", "1 second")
    holder = []
    q = (ev.dropDuplicatesWithinWatermark(["ms"]).select("ms").writeStream
         .foreachBatch(text.context_printer("row", "ms", lambda: text.watermark_ms(holder[0]) if holder else None, _to_files(str(outs))))
         .option("checkpointLocation", str(tmp_path / "wmck")).start())
    holder.append(q)
    q.processAllAvailable()
    wm = text.watermark_ms(q)
    q.stop()
    assert wm == 1634473766000  # the largest time less the lag
    printed = _printed(str(outs))
    assert len(printed) == 3 and all(line.startswith("row:") for line in printed)
    assert any("1634473767000, 1634473767000, " in line for line in printed)  # value, element time, then watermark and subtask


def test_stream_word_counts_upserted_to_kv(spark, tmp_path):
    from tidepool.operators.wordcount import word_count
    from tidepool.sources.files import scan_text
    from tidepool.streaming.jobs import word_count_stream
    src = tmp_path / "wc-in"
    src.mkdir()
    lines = ["flink spark", "hello world", "flink spark", "spark hbase hbase flink flink", "   hbase"]
    for i, line in enumerate(lines):
        f = src / f"{i}.txt"
        f.write_text(line + "\n")
        os.utime(f, (1_600_000_000 + i, 1_600_000_000 + i))
    root = str(tmp_path / "kv-wc")
    q = kv.stream_to_kv(word_count_stream(scan_text(spark, str(src), True, 1)), "word", "cnt",
                        functools.partial(FileKVClient, root), str(tmp_path / "kv-ck"), interval="0 seconds")
    q.processAllAvailable()
    q.stop()
    final, _ = FileKVClient.read_all(root)
    batch = {w: str(c) for w, c in rows(word_count(scan_text(spark, str(src))))}
    assert final == batch


def test_enrich_lookup_timeout_gives_default(spark):
    """A call's time starts when it does: ten calls that hang do not take the
    healthy keys behind them along."""
    import time as _t
    from tidepool.operators.enrich import enrich_lookup
    from tidepool.sources.lookup import table_geocoder

    def slow(addr):
        if addr.startswith("slow"):
            _t.sleep(3)
        return table_geocoder(addr)
    df = spark.createDataFrame([(i, f"slow {i}2") for i in range(10)] + [(i, f"fast {i}2") for i in range(10, 40)],
                               "id long, addr string").coalesce(1)
    out = {r.id: r.title for r in enrich_lookup(df, "addr", slow, timeout_s=0.3, partitions=1).collect()}
    assert {i for i, title in out.items() if not title} == set(range(10))


def test_enrich_lookup_on_a_stream(spark, tmp_path):
    from tidepool.operators.enrich import enrich_lookup
    from tidepool.sources.files import scan_text
    from tidepool.sources.lookup import table_geocoder
    src = tmp_path / "addr"
    src.mkdir()
    (src / "a.txt").write_text("street 2\nstreet 7\nstreet 2\n")
    df = enrich_lookup(scan_text(spark, str(src), stream=True), "line", table_geocoder)
    q = df.writeStream.format("memory").queryName("enriched").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.line, r.title) for r in spark.table("enriched").collect()) == [
        ("street 2", "STREET 2"), ("street 2", "STREET 2"), ("street 7", "")]


def test_checkpoint_folder_is_asked_for_off_local():
    from types import SimpleNamespace

    import pytest
    from tidepool import session
    conf = {"spark.master": "yarn"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=conf.get)))
    assert not session.is_local(SimpleNamespace(conf=SimpleNamespace(get={"spark.master": "local-cluster[2,1,512]"}.get)))
    assert session.is_local(SimpleNamespace(conf=SimpleNamespace(get={"spark.master": "local[4]"}.get)))


def test_stream_sinks_text_and_jdbc(spark, tmp_path):
    """Parsed order lines streamed to a text sink and, per micro-batch, to a
    JDBC table; a restart re-reads nothing and duplicates nothing."""
    from tidepool.functions.parse import parse_orders
    from tidepool.sources.files import scan_text
    src = tmp_path / "orders-in"
    src.mkdir()
    for i in range(4):
        f = src / f"{i}.txt"
        f.write_text(f"o{i},1,{i + 1},{1634473761000 + i}\n")
        os.utime(f, (1_600_000_000 + i, 1_600_000_000 + i))
    url = f"jdbc:derby:{tmp_path}/sinkdb;create=true"

    def start():
        good, _ = parse_orders(scan_text(spark, str(src), True, 1))
        q1 = text.stream_text(good, str(tmp_path / "txt-out"), str(tmp_path / "ck-txt"),
                              ["order_id", "money"])
        q2 = (good.writeStream.foreachBatch(jdbc.foreach_batch_writer(url, "ORDERS_STREAM", DERBY))
              .option("checkpointLocation", str(tmp_path / "ck-jdbc")).start())
        for q in (q1, q2):
            q.processAllAvailable()
            q.stop()

    start()
    start()  # restart from the checkpoints: no new files, nothing rewritten
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "txt-out")).collect()) == \
        ["o0,1", "o1,2", "o2,3", "o3,4"]
    back = spark.read.jdbc(url, "ORDERS_STREAM", properties=DERBY)
    assert back.count() == 4 and back.select("batch_id").distinct().count() == 4
