"""Sorts, limits, top-k (T1-T5) and dense numbering without a single-partition window."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.operators.validate import score_threshold


def ranking_order(score_col: str = "match_score", seq: str = "input_seq"):
    """Score descending, ties in input order (a unique, total order)."""
    return [F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)).desc(), F.col(seq).asc()]


def rank_postings(df: DataFrame, score_col: str = "match_score", seq: str = "input_seq") -> DataFrame:
    """The stable ranking as a distributed sort (range partitioning + local sort)."""
    return df.orderBy(*ranking_order(score_col, seq))


def with_dense_rank(df: DataFrame, order, name: str = "rank", start: int = 1, wide: bool = False) -> DataFrame:
    """Number rows 1..n in a total ``order`` without funnelling them through one task.

    The rows are written first, since the sort computes its input twice (once for
    the sample that cuts the ranges).  The sorted table is written too, each row with its
    partition; per-partition row counts (one row per partition) give each partition its
    offset, and each row adds its position inside its partition.

    ``wide``: only what the order needs is sorted and written again; the rows, in no order, get their number by a join, so
    what reads a few of their columns shuffles these alone.
    """
    from hirelens.session import drop_path, scratch_path

    spark = df.sparkSession
    root = scratch_path(spark, f"ranked-{uuid.uuid4().hex}")
    rows = df.withColumn("_row", F.monotonically_increasing_id()) if wide else df
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{root}/rows")
    s = rows.orderBy(*order)
    s = (s.select("_row") if wide else s)
    s = (s.withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    s.write.parquet(f"{root}/sorted")
    if not wide:
        drop_path(spark, f"{root}/rows")
    s = spark.read.schema(s.schema).parquet(f"{root}/sorted")
    offsets = (s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
               .withColumn("_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
               .select("_pid", "_first", F.coalesce(F.col("_off"), F.lit(0)).alias("_off")))
    # One row per partition: bounded by the partition count, not by the data.
    out = s.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first") + F.lit(start)).cast("bigint")) \
        .drop("_pid", "_mid", "_first", "_off")
    return rows.join(out, "_row").drop("_row") if wide else out


def top_k(df: DataFrame, k: int, score_col: str = "match_score", seq: str = "input_seq") -> DataFrame:
    """T2 (k=50) / T3 (k=20): planned as TakeOrderedAndProject (per-partition top-k, then merge)."""
    return df.orderBy(*ranking_order(score_col, seq)).limit(k)


def top_k_per_group(df: DataFrame, k: int, group: str, score_col: str = "match_score",
                    seq: str = "input_seq", name: str = "rank") -> DataFrame:
    """Top k per group (a profile, a search criterion).

    One window: Spark's window group limit cuts every group to k rows in each input
    partition before the shuffle, so a group that holds a third of all rows is cut
    where it lies.
    """
    w = Window.partitionBy(group).orderBy(*ranking_order(score_col, seq))
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def notification_set(df: DataFrame, min_score: float = 0.5, max_jobs: int = 10,
                     score_col: str = "match_score", seq: str = "input_seq") -> DataFrame:
    """T4: threshold (F7), then the first ``max_jobs`` of the ranking; ``max_jobs <= 0`` = all."""
    q = score_threshold(df, min_score, score_col)
    return top_k(q, max_jobs, score_col, seq) if max_jobs > 0 else rank_postings(q, score_col, seq)
