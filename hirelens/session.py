"""Session construction and cluster-shared locations."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hirelens", extra: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC clock, Arrow batches and no web UI.

    On a cluster ``master`` is left to ``spark-submit``; tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # checkpoint files go when nothing refers to their data any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Arrow batches for the difflib / html UDFs: long texts, keep batches modest.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the executor; give it room for codegen and shuffles.
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) is a private folder created and
    registered; on a cluster the configured, shared location is always used.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} is unset: name a folder shared by the cluster")
        d = fallback or tempfile.mkdtemp(prefix="hirelens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A per-run sub-folder of the shared checkpoint location (for written tables)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)


def drop_path(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables that no plan reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), so that UDFs
    import it wherever the session was started from."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="hirelens-ship-"), "hirelens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
