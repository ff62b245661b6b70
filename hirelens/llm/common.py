"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.joins import join_keyed
from hirelens.session import checkpoint_dir, ship_package
from hirelens.sources.tables import table

__all__ = ["Scratch", "claim", "components", "fold_of", "join_keyed", "ready", "table", "text_key"]

#: Rows and bytes of one Arrow batch: bound the memory of a Python worker, on long texts too.
ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20

#: The operator whose caches this Python worker holds, and what frees them.
_HOLDER: list = [None, None]


def claim(operator: str, free: Callable[[], None] | None = None) -> None:
    """Called in a worker before an operator computes: what another operator keeps there between its
    tasks is freed first, so that a reused worker never holds the caches of two."""
    if _HOLDER[0] == operator:
        return
    if _HOLDER[1] is not None:
        _HOLDER[1]()
    _HOLDER[:] = [operator, free]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
    if trim is not None:
        trim(0)


def ready(spark: SparkSession) -> None:
    """Shared checkpoint folder, package on the workers, modest Arrow batches."""
    checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


class Scratch:
    """Tables written below the cluster's shared checkpoint folder, to cut lineage.

    Each run has a folder of its own.  ``drop`` frees a table that nothing needs any more;
    what a returned plan still reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        ready(spark)
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for n in names:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}")
            p.getFileSystem(conf).delete(p, True)


def text_key(text: Column | str) -> Column:
    """64-bit hash of a text; a null text has a key of its own."""
    c = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(c, c.isNull())


def fold_of(doc_id: Column | str, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id falls into fold 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(0))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, comp) per node on an edge,
    comp the smallest node reachable.

    Each round every node takes its smallest neighbour (or itself) as parent, parents jump to
    their parent's parent, and the edges are drawn between the parents; edges within one
    parent go.  The graph shrinks from round to round and the rounds grow with the logarithm
    of the diameter.  Each round is written to the shared folder.  Works on columns of any
    ordered type; a hub's edges are spread by the partial aggregation.
    """
    both = edges.select("a", "b").filter("a != b")
    both = scratch.write(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges-0")
    alone = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    lab, i = None, 0
    while lab is None or both.limit(1).count():
        parent = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                               .select("node", F.least("node", "m").alias("up")), f"{name}-parents-{i}")
        jump = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        root = parent.join(jump, "up", "left").select("node", F.coalesce("top", "up").alias("root"))
        root = scratch.write(root, f"{name}-roots-{i}")
        if lab is None:
            lab = root.withColumnRenamed("root", "comp")
        else:
            lab = (lab.join(root.select(F.col("node").alias("comp"), "root"), "comp", "left")
                   .select("node", F.coalesce("root", "comp").alias("comp")))
        lab = scratch.write(lab, f"{name}-{i}")
        drawn = (both.join(root.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                 .join(root.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b"))
        both = scratch.write(drawn.filter("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), f"{name}-edges-{i + 1}")
        scratch.drop(f"{name}-edges-{i}", f"{name}-parents-{i}", f"{name}-roots-{i}", *([f"{name}-{i - 1}"] if i else []))
        i += 1
    alone = alone.join(lab, "node", "left_anti").select("node", F.col("node").alias("comp"))
    return lab.unionByName(alone)
