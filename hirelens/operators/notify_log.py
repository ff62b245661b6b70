"""A posting is notified once per profile, whatever is run again.

The log has one folder for each epoch (a run's or micro-batch's number) with what it sent: profile, id,
rank, notified_on.  An epoch is recorded by renaming its finished folder into place, once; from then on a
replay reads the folder and has nothing to send.  A run that dies before the rename has sent nothing, since the rows
to send are those of the recorded folder.  Entries older than ``expiry_days`` no longer count, so that the log's
part that a run joins is bounded in time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.rank import top_k_per_group
from hirelens.operators.validate import score_threshold

SCHEMA = "profile string, id string, rank int, match_score double, notified_on date"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def recorded(spark: SparkSession, log: str, epoch: int) -> DataFrame | None:
    """What ``epoch`` sent, or None if it is not recorded."""
    fs, p = _fs(spark, f"{log}/epoch={epoch}")
    return spark.read.schema(SCHEMA).parquet(p.toString()) if fs.exists(p) else None


def sent_before(spark: SparkSession, log: str, run_date: str, expiry_days: int | None) -> DataFrame:
    """(profile, id) of the entries that still count on ``run_date``."""
    fs, p = _fs(spark, log)
    if not fs.exists(p) or not any(s.getPath().getName().startswith("epoch=") for s in fs.listStatus(p)):
        return spark.createDataFrame([], "profile string, id string")
    entries = spark.read.schema(SCHEMA).option("basePath", log).parquet(f"{log}/epoch=*")
    if expiry_days is not None:
        entries = entries.filter(F.col("notified_on") > F.date_sub(F.lit(run_date).cast("date"), expiry_days))
    return entries.select("profile", "id").distinct()


def notify_once(scored: DataFrame, log: str, epoch: int, run_date: str, min_score: float = 0.5, max_jobs: int = 10, expiry_days: int | None = None,
                key: str = "id", seq: str = "input_seq") -> DataFrame:
    """The rows that epoch ``epoch`` has to send (profile, id, rank, match_score, notified_on): for each profile of
    ``scored`` the best ``max_jobs`` at or above ``min_score`` that were not sent before.  None if the epoch is
    recorded already."""
    spark = scored.sparkSession
    if recorded(spark, log, epoch) is not None:
        return spark.createDataFrame([], SCHEMA)
    rows = score_threshold(scored, min_score).withColumn("_key", F.col(key).cast("string"))
    before = sent_before(spark, log, run_date, expiry_days).withColumnsRenamed({"profile": "_p", "id": "_i"})
    fresh = rows.join(before, (F.col("profile") == F.col("_p")) & (F.col("_key") == F.col("_i")), "left_anti")
    best = top_k_per_group(fresh, max_jobs, "profile", seq=seq)
    staged = f"{log}/_staged-{uuid.uuid4().hex}"
    (best.select("profile", F.col("_key").alias("id"), "rank", F.col("match_score").cast("double").alias("match_score"), F.lit(run_date).cast("date").alias("notified_on"))
     .write.parquet(staged))
    fs, source = _fs(spark, staged)
    _, target = _fs(spark, f"{log}/epoch={epoch}")
    # another run of the epoch may have recorded it meanwhile: then this one has nothing to send
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, True)
        return spark.createDataFrame([], SCHEMA)
    return recorded(spark, log, epoch)
