"""Operator 6, MinHash near-dedup with b-bit signatures.

1. A text becomes the set of its five-word shingles (64-bit hashes).  One pass over the texts
   gives the class (128-bit hash of the word sequence), the set's size, and 32 band keys of four
   minima each.  Texts of one class are copies; from here on a class stands for them, so copies
   are never compared.
2. Classes that share a band key are candidates.  Their signatures keep the lowest bit of each
   of 2,048 minima, packed into 32 integers.  A candidate pair is dropped, within the join, if the
   sizes exclude the similarity, or if the estimate from the bit counts,
   (m / k - 2^-b) / (1 - 2^-b) for m equal of k values, lies four standard errors below the
   threshold.  All others are confirmed on the full shingle sets.
3. In each bucket all members are compared with ``HUBS`` hubs, the first ones in as many orders
   by hash (so that the buckets of a group have few different hubs), and confirmed links are
   joined to components.  What is then outside of a bucket's largest component is compared with
   all members of other components, each pair in the first bucket that it shares.  A group of
   thousands of near copies thus costs a few pairs per member, not one per pair, and no link
   between different components is lost.

A pair of similarity 0.75 shares no band with probability (1 - 0.75^4)^32 = 5e-6.

Defined results: words are split at ASCII white space after lower-casing A-Z; a text with fewer
than five words is one shingle; null texts and texts without words have an empty set and link
with nothing; repeated rows are copies; a null doc_id is never the smallest one of a component
that has another id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import Scratch, claim, components, table, text_key

SHINGLE = 5
MINIMA = 128
BAND_ROWS = 4
HUBS = 3
#: Minima whose lowest bit the signature keeps.
BITS = 2048
LONGS = BITS // 64
#: Candidate classes whose keys may be broadcast to find their texts; more are joined by a shuffle.
MAX_BROADCAST = 500_000

_RNG = np.random.default_rng(20240601)
_MUL = _RNG.integers(1, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, BITS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased (bytes methods do exactly this)."""
    return text.encode().lower().split() if text else []


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word sequences of ``size`` words (the whole, if fewer)."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    h = w[: len(w) - n + 1].copy()
    for i in range(1, n):
        h = h * _STEP + w[i: len(w) - n + 1 + i]
    return np.unique(_mixed(h + np.uint64(n)))


def minima_of(hashes: np.ndarray, k: int = MINIMA) -> np.ndarray:
    low = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, (1 << 18) // k)
    for i in range(0, len(hashes), step):
        part = _MUL[:k, None] * hashes[None, i:i + step]
        part += _ADD[:k, None]
        np.minimum(low, part.min(axis=1), out=low)
    return _mixed(low)


def packed_of(hashes: np.ndarray) -> np.ndarray:
    """The lowest bits of BITS minima as LONGS integers."""
    low = (minima_of(hashes, BITS) & np.uint64(1)).reshape(-1, 64)
    return np.bitwise_or.reduce(low << np.arange(64, dtype=np.uint64), axis=1).view(np.int64)


def _bands(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(-1, BAND_ROWS)
    h = np.arange(len(rows), dtype=np.uint64) + np.uint64(1)
    for i in range(BAND_ROWS):
        h = h * _STEP + rows[:, i]
    return _mixed(h).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, cls (null without words), n_shingles, bands."""
    src = docs.select("doc_id", text_key("text").alias("text_key"), "text")
    schema = T.StructType([src.schema["doc_id"], T.StructField("text_key", T.LongType()),
                           T.StructField("cls", T.BinaryType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        claim("minhash")
        for b in batches:
            cls, n, bands = [], [], []
            for t in b.column(2).to_pylist():
                words = words_of(t)
                h = shingle_hashes(words)
                n.append(len(h))
                cls.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                bands.append(_bands(minima_of(h)) if words else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "cls", "n_shingles", "bands"])

    return src.mapInArrow(run, schema)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(cls, text) -> (cls, n, shingles: sorted hash array, packed)."""
    def run(batches):
        claim("minhash")
        longs = pa.list_(pa.int64())
        for b in batches:
            sets = [shingle_hashes(words_of(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], longs),
                 pa.array([packed_of(x) for x in sets], longs)], ["cls", "n", "shingles", "packed"])

    return texts.select("cls", "text").mapInArrow(run, "cls binary, n long, shingles array<long>, packed array<long>")


def shared(a: Column | str, b: Column | str) -> Column:
    """Size of the intersection of two sorted distinct arrays."""
    @F.arrow_udf("long")
    def size(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = a.values.to_numpy(), b.values.to_numpy()
        i, j = a.offsets.to_numpy(), b.offsets.to_numpy()
        out = np.zeros(len(a), np.int64)
        for k in range(len(a)):
            out[k] = len(np.intersect1d(x[i[k]:i[k + 1]], y[j[k]:j[k + 1]], assume_unique=True))
        return pa.array(out)

    return size(a, b)


def likely(a: str, b: str, percent: int) -> Column:
    """Whether the sizes (prefix n) and packed signatures (p0, p1, ...) of two sides allow a link."""
    off = F.lit(0)
    for i in range(LONGS):
        off = off + F.bit_count(F.col(f"{a}p{i}").bitwiseXOR(F.col(f"{b}p{i}")))
    chance, p = 0.5, percent / 100.0
    estimate = ((F.lit(BITS) - off) / F.lit(float(BITS)) - chance) / (1 - chance)
    same = p + (1 - p) * chance
    cutoff = p - 4 * (same * (1 - same) / BITS) ** 0.5 / (1 - chance)
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & (estimate >= cutoff)


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept for each row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    rows = scratch.write(signatures(docs), "rows")
    classes = scratch.write(
        rows.filter("cls IS NOT NULL").groupBy("cls")
        .agg(F.min("doc_id").alias("min_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("at"),
             F.first("bands").alias("bands")), "classes")

    banded = classes.select("cls", F.explode("bands").alias("band"))
    shared_bands = banded.groupBy("band").agg(F.count("*").alias("m")).filter("m > 1").select("band")
    spots = scratch.write(banded.join(shared_bands, "band"), "spots")
    wanted = scratch.write(spots.select("cls").distinct().join(classes.select("cls", "at"), "cls")
                           .select("cls", F.col("at.doc_id").alias("w_id"), F.col("at.text_key").alias("w_key")), "wanted")
    n_wanted = wanted.count()
    texts = docs.select("doc_id", "text").withColumn("text_key", text_key("text"))
    found = texts.join(F.broadcast(wanted) if n_wanted <= MAX_BROADCAST else wanted,
                       (F.col("text_key") == F.col("w_key")) & F.col("doc_id").eqNullSafe(F.col("w_id")))
    sets = scratch.write(shingle_sets(found.select("cls", "text")), "sets")
    if sets.count() > n_wanted:  # repeated rows of the input
        sets = scratch.write(sets.dropDuplicates(["cls"]), "sets-once")
    own = ["cls", "n", *[f"p{i}" for i in range(LONGS)]]
    light = sets.select("cls", "n", *[F.get("packed", i).alias(f"p{i}") for i in range(LONGS)])
    members = scratch.write(spots.join(light, "cls"), "members")

    def confirm(pairs: DataFrame) -> DataFrame:
        """The linked ones of (a, b, n, ...), n the sum of the sizes."""
        full = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("s_a")), "a")
                .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("s_b")), "b")
                .withColumn("i", shared("s_a", "s_b")))
        return full.filter(F.col("i") * 100 >= (F.col("n") - F.col("i")) * percent).drop("s_a", "s_b", "i", "n")

    hubs = members.groupBy("band").agg(*[
        F.min_by(F.struct(*own), F.xxhash64("cls", F.lit(h))).alias(f"hub{h}") for h in range(HUBS)])
    near = (members.join(hubs, "band").withColumn("hub", F.explode(F.array(*[f"hub{h}" for h in range(HUBS)])))
            .select(*own, *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in own])
            .filter((F.col("cls") != F.col("hub_cls")) & likely("", "hub_", percent))
            .select(F.least("cls", "hub_cls").alias("a"), F.greatest("cls", "hub_cls").alias("b"), (F.col("n") + F.col("hub_n")).alias("n")))
    comps = components(scratch.write(confirm(near.distinct()), "links"), scratch, "comps")

    now = scratch.write(members.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
                        .withColumn("comp", F.coalesce("comp", "cls")), "now")
    main = (now.groupBy("band", "comp").agg(F.count("*").alias("c"))
            .groupBy("band").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("k")).filter("k > 1"))
    still = scratch.write(now.join(main.select("band", "main"), "band").join(classes.select("cls", "bands"), "cls"), "open")
    rest = still.filter("comp != main").select("band", "comp", "bands", *own)
    other = still.select("band", F.col("comp").alias("o_comp"), (F.col("comp") == F.col("main")).alias("o_main"),
                         F.col("bands").alias("o_bands"), *[F.col(c).alias(f"o_{c}") for c in own])
    pairs = (rest.join(other, (rest["band"] == other["band"]) & (F.col("comp") != F.col("o_comp"))
                       & (F.col("o_main") | (F.col("cls") < F.col("o_cls"))) & likely("", "o_", percent)
                       & (F.get(F.array_intersect("bands", "o_bands"), F.lit(0)) == rest["band"]))
             .select(F.col("cls").alias("a"), F.col("o_cls").alias("b"), (F.col("n") + F.col("o_n")).alias("n"),
                     F.col("comp").alias("comp_a"), F.col("o_comp").alias("comp_b")))
    more = scratch.write(confirm(pairs).select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")), "more-links")
    joined = components(more, scratch, "joined").select(F.col("node").alias("comp"), F.col("comp").alias("top"))

    named = (classes.select("cls", "min_id").join(comps.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("comp", F.coalesce("comp", "cls")).join(joined, "comp", "left")
             .withColumn("comp", F.coalesce("top", "comp")))
    least = named.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    named = named.join(least, "comp").select("cls", "component_id")
    out = rows.select("doc_id", "text_key", "cls", "n_shingles").join(named, "cls", "left")
    return out.select("doc_id", "text_key", "n_shingles",
                      F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` without the rows that are not kept; repeated rows stay once."""
    found = near_duplicates(docs, percent).select("doc_id", "text_key", "kept")
    kept = found.filter("kept")
    once = kept.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    repeated = once.filter("n > 1").limit(1).count() > 0
    gone = (found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct())
    out = docs.join(gone, (text_key(docs["text"]) == F.col("gone_key")) & docs["doc_id"].eqNullSafe(F.col("gone_id")), "left_anti")
    return out.dropDuplicates(["doc_id", "text"]) if repeated else out


def op6(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


#: Brute force in DuckDB: shared shingles of all pairs, then reachability.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, both_ways.b FROM r JOIN both_ways ON r.seen = both_ways.a),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
