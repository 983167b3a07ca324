"""The driver contract, and every registered query against its oracle SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from tidepool.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["app_id", "day", "window_start", "day_uv"]
    assert df.count() > 0


def test_every_sql_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _canon(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, res.fetchall())


@pytest.mark.parametrize("name", ["time_funcs", "parse_event_line", "tumbling_sum", "day_window", "late_split",
                                  "daily_uv_cumulative", "uv_running"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    """Times travel as epoch ms and calendar work names its zone, so a driver
    session in a DST zone gives the same answers."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF)
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(E.oracle_sql()[name])
    assert got == _canon([d[0] for d in res.description], res.fetchall())


def test_python_workers_import_package_from_any_cwd(tmp_path):
    """The driver may import the entry module from another directory; plans
    that run Python on workers must still find the package (shipped with
    ``addPyFile``)."""
    import subprocess
    import sys
    import textwrap
    script = tmp_path / "drive.py"
    script.write_text(textwrap.dedent("""
        import importlib.util
        spec = importlib.util.spec_from_file_location("__spark_entry__", "/root/repo/__spark_entry__.py")
        E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        print(E.queries()["running_median"](spark, "/root/testdata/sf0.001").count(),
              E.queries()["enrich_lookup"](spark, "/root/testdata/sf0.001").count())
    """))
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("1000 150"), out.stderr[-2000:]


def test_every_query_handles_empty_tables(spark, tmp_path):
    """Same schemas, zero rows: every registered query plans and runs."""
    for t in TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    failures = {}
    for name, fn in E.queries().items():
        try:
            n = fn(spark, str(tmp_path)).count()
            if n:
                failures[name] = f"{n} rows"
        except Exception as e:  # collect all failures for one report
            failures[name] = str(e).splitlines()[0][:200]
    assert not failures, failures


@pytest.mark.parametrize("name", ["running_count", "count_window", "late_split", "late_split_events", "uv_running"])
def test_chunked_prefix_queries_with_many_chunks(spark, con, monkeypatch, name):
    """Force narrow chunks so the per-(key, chunk) windows and the chunk
    offsets are exercised on the small tables too, then compare with the oracle."""
    import tidepool.operators.prefix as P
    orig = P.running_agg

    def narrow(df, keys, order_cols, value, how, out, chunk_span=None, chunk_col=None):
        return orig(df, keys, order_cols, value, how, out, chunk_span, chunk_col, chunk_rows=50)
    for mod in ("wordcount", "windows", "late", "uv"):
        monkeypatch.setattr(f"tidepool.operators.{mod}.running_agg", narrow)
    df = E.queries()[name](spark, SF)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    assert got == _canon([d[0] for d in res.description], res.fetchall())
