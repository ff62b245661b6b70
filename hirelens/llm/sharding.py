"""Operator 10, sharding: vector bin packing of bytes, tokens and rows.

Equal texts form a group.  What is packed are *cells*: a group that holds at least
1 / ``cells`` of all bytes, tokens or rows is heavy and gets cells of its own; all other groups
are dealt over ``cells`` cells by the hash of their text.  There are at most 3 * ``cells``
heavy groups, so the vectors that the driver packs are bounded by the parameter at any size of
input.  The largest vector is placed first, each where its dot product with the shards' residual
capacity (a share of all bytes, tokens and rows) is highest; a last pass moves cells between shards
while the byte sizes come closer and no dimension's fullest shard gets fuller.

A heavy group stays in one shard unless it is larger than a shard's fair share; then it is cut
by row.  Slots are numbered within pieces of at most about 1 / ``cells`` of the
rows and shifted by the rows of the shard's earlier pieces, so no window holds a hot group.

Law ``bytes``: shard sizes near equal.  Defined results: a null text has size 1, no tokens, a
null crc and is its own group, apart from empty texts; rows with null or repeated doc_id are
rows like any other; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, table

WORD = r"[^\x20\x09-\x0D]+"
DIMS = ["size", "tokens", "rows"]


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each vector (cells x dimensions, as shares of the whole; the first one is bytes).

    Largest vector first, each where its dot product with the residual capacity is highest.  Then cells move from
    the shards with most to those with least bytes, as long as a move brings two shards' bytes closer and raises
    no dimension above what its fullest shard has; every move lowers the sum of squared sizes, so this ends.
    """
    dims = vectors.shape[1]
    shard = np.zeros(len(vectors), dtype=np.int64)
    room = np.full((n_shards, dims), 1.0 / n_shards)
    for i in np.argsort(-vectors.max(axis=1), kind="stable"):
        s = int(np.argmax(room @ vectors[i]))
        shard[i] = s
        room[s] -= vectors[i]
    load = np.stack([np.bincount(shard, weights=vectors[:, d], minlength=n_shards) for d in range(dims)], axis=1)
    members = [np.flatnonzero(shard == s) for s in range(n_shards)]
    moved = True
    while moved:
        moved = False
        top, order = load.max(axis=0) + 1e-12, np.argsort(-load[:, 0], kind="stable")
        for hi, lo in ((h, o) for h in order for o in order[::-1] if load[h, 0] > load[o, 0]):
            own = members[hi]
            gap = load[hi, 0] - load[lo, 0]
            fits = own[(vectors[own, 0] < gap * (1 - 1e-9)) & (load[lo] + vectors[own] <= top).all(axis=1)]
            if len(fits):
                best = fits[np.argmin(np.abs(vectors[fits, 0] - gap / 2))]
                load[hi] -= vectors[best]
                load[lo] += vectors[best]
                shard[best] = lo
                members[hi], members[lo] = own[own != best], np.append(members[lo], best)
                moved = True
                break
    return shard


def shards(docs: DataFrame, n_shards: int = 16, cells: int = 16384) -> DataFrame:
    """doc_id, size, text_crc32, tokens, shard, slot for each row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    base = scratch.write(docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.unhex(F.md5(F.col("text").cast("binary"))), F.lit(b"")).alias("group_key"))
        .withColumn("size", F.col("n_bytes") + 1).withColumn("row", F.monotonically_increasing_id()), "base")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = base.agg(*sums).first()
    if not total.rows:
        return base.select("doc_id", "size", "text_crc32", "tokens", F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"))
    whole = np.maximum(np.array([total[d] for d in DIMS], dtype=np.float64), 1.0)

    share = F.greatest(*[F.col(d) / F.lit(float(w)) for d, w in zip(DIMS, whole)])
    heavy = (base.groupBy("group_key").agg(*sums).withColumn("share", share)
             .filter(F.col("share") >= 1.0 / cells)
             .select("group_key", F.ceil(F.col("share") * cells).cast("long").alias("parts"),
                     (F.col("share") > 1.0 / n_shards).alias("cut")))
    heavy = scratch.write(heavy.coalesce(1), "heavy")
    # cell: what is numbered; unit: what is placed (a whole heavy group unless it is cut)
    named = (base.join(F.broadcast(heavy), "group_key", "left")
             .withColumn("part", F.when(F.col("parts").isNotNull(),
                                        F.pmod(F.xxhash64("row"), F.col("parts"))).otherwise(F.lit(-1)))
             .withColumn("cell", F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("group_key"), F.lit(cells)))
                         .otherwise(F.xxhash64("group_key", "part"))))
    unit = F.when(F.col("part") < 0, F.col("cell")).when(F.col("cut"), F.col("cell")).otherwise(F.xxhash64("group_key"))
    rows = (named.groupBy(F.col("part") >= 0, "cell")
            .agg(*sums, F.min(unit).alias("unit"), F.min(F.col("part") >= 0).alias("own")).toPandas())
    rows = rows.sort_values(["own", "unit", "cell"], kind="stable").reset_index(drop=True)
    unit_no = rows.groupby(["own", "unit"], sort=False).ngroup().to_numpy()
    vectors = np.zeros((unit_no.max() + 1, len(DIMS)))
    np.add.at(vectors, unit_no, rows[DIMS].to_numpy(dtype=np.float64) / whole)
    rows["shard"] = place(vectors, n_shards)[unit_no]
    rows["first"] = rows.groupby("shard")["rows"].cumsum() - rows["rows"]
    plan = spark.createDataFrame(rows[["own", "cell", "shard", "first"]].astype(
        {"own": bool, "cell": "int64", "shard": "int32", "first": "int64"}),
        "own boolean, cell long, shard int, first long")
    w = Window.partitionBy("own", "cell").orderBy("doc_id", "group_key", "row")
    return (named.withColumn("own", F.col("part") >= 0)
            .join(F.broadcast(plan), ["own", "cell"])
            .select("doc_id", "size", "text_crc32", "tokens", "shard",
                    (F.col("first") + F.row_number().over(w) - 1).alias("slot")))


def op10(spark, sf_dir) -> DataFrame:
    return shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens")
