"""Session construction and shared-folder resolution.

On a cluster the session is created by the launcher; ``configure`` only fills
in what is unset. Local helpers exist for tests and the benchmark.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and partition counts from
# runtime sizes; the broadcast threshold is Spark's own size check, so a side
# is broadcast only when its measured size is under it.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  zone: str = "UTC", app: str = "tidepool") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", zone)
        .config("spark.driver.memory", os.environ.get("TIDEPOOL_DRIVER_MEMORY", "16g"))
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a folder every executor can reach; we read it from the
    session. Only when it is unset and the master is local (tests) do we
    create our own: on a cluster, a folder of this machine would be one that
    the executors cannot see.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def is_local(spark: SparkSession) -> bool:
    """True for ``local`` and ``local[...]`` masters (not for local-cluster)."""
    return re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")) is not None


def subdir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder, e.g. for a streaming checkpoint."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}"


_SHIPPED: set[str] = set()


def _workers_can_import(spark: SparkSession) -> bool:
    """One tiny job: can an executor Python worker import this package?"""
    def probe(batches):
        import importlib.util

        import pandas as pd
        for _ in batches:
            pass
        yield pd.DataFrame({"ok": [importlib.util.find_spec("tidepool") is not None]})

    try:
        return all(r.ok for r in spark.range(1, numPartitions=1).mapInPandas(probe, "ok boolean").collect())
    except Exception:
        return False


def ship_package(spark: SparkSession) -> None:
    """Make ``tidepool`` importable in executor Python workers.

    Plans that run Python on workers (``mapInPandas``, state processors)
    unpickle functions that refer to this package. A cluster launched with
    ``--py-files`` (or with the package installed) already has it: a probe
    job checks once per application and nothing is shipped. Otherwise the
    package's sources are zipped (into the shared folder when it is a local
    path, as in tests) and distributed with ``addPyFile``, as ``--py-files``
    would.
    """
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # a Connect session has no SparkContext
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    if _workers_can_import(spark):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    shared = spark.conf.get("spark.checkpoint.dir", None) or ""
    local_shared = shared.removeprefix("file:")
    folder = local_shared if local_shared and os.path.isdir(local_shared) else None
    fd, path = tempfile.mkstemp(prefix="tidepool-", suffix=".zip", dir=folder)
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder_, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder_, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(path)
    else:
        spark.addArtifacts(path, pyfile=True)
