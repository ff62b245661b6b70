"""Splittable reader of JSON array files (S1): one large array is parsed by many tasks.

Spark's text source cuts a file into byte ranges if its rows end at a one-character
separator, so the rows here are the stretches up to each ``}``.  Where an element of the
top-level array ends follows from a prefix scan over these stretches:

1. each stretch has its bytes, its quotes (parity), and its change of bracket depth under either
   assumption on the state it begins in (outside or inside a string); escaped characters are taken out;
2. within a byte range a window gives the state and the sums under both assumptions; over the
   ranges of a file, one row each, a second window links them: true state, depth and byte offset of every
   range's first stretch;
3. a stretch that closes an object at depth one outside strings ends a *segment*: the text of one or
   more elements.  Segments within a range are put together where the window left their stretches;
   only those that cross ranges are shuffled again;
4. each segment is parsed as a small array of its own.

``offset`` is the byte offset of the element's segment in the file plus its place in the segment: unique
in the file, in file order, whatever the size of the ranges.  Compressed files are one range.  The
stretches are written once to the shared checkpoint folder, so that later steps see the same ranges
when executors are lost.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from hirelens.operators.normalize import once
from hirelens.session import drop_path, scratch_path

#: A segment beyond this many bytes is no record (a row's value ends at 2 GB): the file counts as corrupt from there.
MAX_SEGMENT = 1 << 28
SPACE = r"[ \t\r\n]"
RANGE = ["source_ord", "path", "block"]


def _depth(text: Column) -> Column:
    """Brackets opened less brackets closed."""
    return F.length(F.regexp_replace(text, r"[^\[{]", "")) - F.length(F.regexp_replace(text, r"[^\]}]", ""))


def _parts(pieces: Column, rest: int) -> Column:
    """The pieces between quotes at places of remainder ``rest``, joined."""
    return F.array_join(F.filter(pieces, lambda p, i: i % 2 == rest), "")


def stretches(spark: SparkSession, paths: list[str], order: int) -> DataFrame:
    """The rows of the text source with what the scan needs: flip (odd quotes), d0 and d1 (change of
    depth if it begins outside or inside a string, the closing bracket included), bytes."""
    raw = spark.read.option("lineSep", "}").text(paths)
    raw = raw.select(F.lit(order).alias("source_ord"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"), "value")
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    raw = raw.withColumn("_q", F.explode(F.array(F.split(bare, '"', -1))))
    flip = (F.size("_q") - 1) % 2
    return raw.select("source_ord", "path", "block", "row", "value", flip.alias("flip"), (_depth(_parts(F.col("_q"), 0)) - F.when(flip == 0, 1).otherwise(0)).alias("d0"),
                      (_depth(_parts(F.col("_q"), 1)) - F.when(flip == 1, 1).otherwise(0)).alias("d1"), (F.octet_length("value") + 1).cast("long").alias("bytes"))


def _scan(rows: DataFrame) -> DataFrame:
    """Within each range: quote parity before a stretch, and running depth and bytes, its own included."""
    to_here = Window.partitionBy(*RANGE).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*RANGE).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("odd", F.coalesce(F.sum("flip").over(before), F.lit(0)) % 2)
    even = F.col("odd") == 0
    return rows.withColumns({"run0": F.sum(F.when(even, F.col("d0")).otherwise(F.col("d1"))).over(to_here),
                             "run1": F.sum(F.when(even, F.col("d1")).otherwise(F.col("d0"))).over(to_here),
                             "run_bytes": F.sum("bytes").over(to_here)})


def _ranges(scanned: DataFrame) -> DataFrame:
    """One row per range: state, depth and offset it begins with; files that are no array are left out."""
    last = scanned.groupBy(*RANGE).agg(F.sum("flip").alias("flip"), F.max_by("run0", "row").alias("run0"), F.max_by("run1", "row").alias("run1"),
                                       F.max("run_bytes").alias("bytes"), F.max("row").alias("last_row"), F.min_by("opens", "row").alias("opens"))
    # ranges of one file, a row each
    before = Window.partitionBy("source_ord", "path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("source_ord", "path").orderBy("block")
    last = last.withColumn("state", F.coalesce(F.sum("flip").over(before), F.lit(0)) % 2)
    change = F.when(F.col("state") == 0, F.col("run0")).otherwise(F.col("run1"))
    last = last.withColumns({"depth": F.coalesce(F.sum(change).over(before), F.lit(0)), "start": F.coalesce(F.sum("bytes").over(before), F.lit(0)),
                             "is_array": F.first("opens").over(file), "final": F.row_number().over(Window.partitionBy("source_ord", "path").orderBy(F.desc("block"))) == 1})
    return last.filter("is_array").select(*RANGE, "state", "depth", "start", F.when(F.col("final"), F.col("last_row")).alias("final_row"))


def _elements(segments: DataFrame, text: Column, first: Column, final: Column) -> DataFrame:
    """``segments`` with ``items``, the elements of each as a variant array; null if it is no part of an array."""
    ok = F.when(first, text.rlike(rf"^{SPACE}*\[")).otherwise(text.rlike(rf"^{SPACE}*[,\]]"))
    tail = F.regexp_replace(text, rf"\]{SPACE}*\z", "")
    ok = ok & (~final | text.rlike(rf"\]{SPACE}*\z"))
    body = F.regexp_replace(F.when(final, tail).otherwise(text), rf"\A{SPACE}*[\[,]", "")
    bare = F.when(final, tail).otherwise(text).rlike(rf"\A{SPACE}*\[?{SPACE}*\z")
    parsed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))), "$", "array<variant>")
    none = F.array().cast("array<variant>")
    d = once(segments, _ok=ok, _end=ok & bare & final, _parsed=parsed)
    return d.withColumn("items", F.when(F.col("_end"), none).when(F.col("_ok") & (F.size("_parsed") > 0), F.col("_parsed"))).drop("_ok", "_end", "_parsed")


def read_arrays(spark: SparkSession, sources: list[tuple[int, str]], corrupt: str = "file") -> DataFrame:
    """source_ord, path, offset, v: the elements of all array files below the paths.

    ``corrupt``: ``file`` leaves out a file that is not one whole array, ``tail`` keeps what comes before the
    first segment that does not parse (the stretch after the last closing brace belongs to what ends the
    array).  Missing and empty files and files of another form have no elements.
    """
    if corrupt not in ("file", "tail"):
        raise ValueError(f"corrupt: file or tail, not {corrupt}")
    base, found = scratch_path(spark, f"arrays-{uuid.uuid4().hex}"), 0
    for order, path in sources:
        try:
            rows = stretches(spark, [path], order)
        except AnalysisException:
            continue  # a missing file is skipped
        rows.withColumn("opens", F.col("value").rlike(rf"^{SPACE}*\[")).write.mode("append").parquet(f"{base}/stretches")
        found += 1
    if not found:
        return spark.createDataFrame([], "source_ord int, path string, offset long, v variant")
    rows = spark.read.parquet(f"{base}/stretches")
    _ranges(_scan(rows.drop("value"))).write.parquet(f"{base}/ranges")
    known = spark.read.parquet(f"{base}/ranges")
    # the ranges a byte range of text each: Spark may broadcast them by their size
    d = _scan(rows.drop("opens")).join(known, RANGE)
    inside = F.pmod(F.col("state") + F.col("odd") + F.col("flip"), F.lit(2)) == 1
    depth = F.col("depth") + F.when(F.col("state") == 0, F.col("run0")).otherwise(F.col("run1"))
    final = F.coalesce(F.col("row") == F.col("final_row"), F.lit(False))
    d = d.select(*RANGE, "row", "value", "bytes", (F.col("start") + F.col("run_bytes") - F.col("bytes")).alias("at"),
                 (~inside & (depth == 1) & ~final).alias("ends"), final.alias("final"))
    before = Window.partitionBy(*RANGE).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("segment", F.max(F.when(F.col("ends"), F.col("at") + F.col("bytes"))).over(before))
    # pieces of segments within a range; those that begin in an earlier one have no start yet
    piece = (d.groupBy(*RANGE, "segment").agg(F.array_sort(F.collect_list(F.struct("row", "value"))).alias("p"), F.min("at").alias("at"), F.sum("bytes").alias("bytes"),
                                              F.max("ends").alias("ends"), F.max("final").alias("final")))
    piece.select(*RANGE, "segment", "at", "bytes", "ends", "final", F.when(F.col("bytes") <= MAX_SEGMENT, F.array_join(F.col("p.value"), "}")).alias("text")
                 ).write.parquet(f"{base}/pieces")
    drop_path(spark, f"{base}/stretches", f"{base}/ranges")
    pieces = spark.read.parquet(f"{base}/pieces")
    edge = F.col("segment").isNull() | ~F.col("ends")
    # where the segment of an edge piece begins: the last end in an earlier range
    narrow = pieces.filter(edge).select(*RANGE, "segment", "at", "bytes", "ends", "final")
    ends = (pieces.filter("ends").groupBy(*RANGE).agg(F.max(F.col("at") + F.col("bytes")).alias("last_end")))
    spans = known_ranges(pieces).join(ends, RANGE, "left")
    earlier = Window.partitionBy("source_ord", "path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*RANGE, F.coalesce(F.max("last_end").over(earlier), F.lit(0)).alias("open"))
    placed = narrow.join(spans, RANGE).withColumn("segment", F.coalesce("segment", "open"))
    sizes = placed.groupBy("source_ord", "path", "segment").agg(F.sum("bytes").alias("whole"), F.max("ends").alias("closed"))
    crossing = (pieces.filter(edge).join(spans, RANGE).withColumn("segment", F.coalesce("segment", "open"))
                .join(sizes, ["source_ord", "path", "segment"]))
    fits = F.col("whole") <= MAX_SEGMENT
    joined = (crossing.filter(fits).groupBy("source_ord", "path", "segment")
              .agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("p"), F.max("ends").alias("ends"), F.max("final").alias("final"))
              .select("source_ord", "path", "segment", F.array_join(F.col("p.text"), "}").alias("text"), "ends", "final"))
    too_long = sizes.filter(~fits).select("source_ord", "path", "segment", F.lit(None).cast("string").alias("text"), "closed", F.lit(True).alias("final"))
    whole = pieces.filter(~edge).select("source_ord", "path", "segment", "text", "ends", "final")
    segments = whole.unionByName(joined).unionByName(too_long.withColumnRenamed("closed", "ends"))
    # an end is a closing bracket, which the separator took away; a last stretch after one may hold nothing
    text = F.concat("text", F.when(F.col("ends"), F.lit("}")).otherwise(F.lit("")))
    last = ~F.col("ends")
    parsed = _elements(segments, text, F.col("segment") == 0, last).select("source_ord", "path", "segment", "items")
    parsed.write.parquet(f"{base}/parsed")
    drop_path(spark, f"{base}/pieces")
    parsed = spark.read.parquet(f"{base}/parsed")
    bad = parsed.filter(F.col("items").isNull()).groupBy("source_ord", "path").agg(F.min("segment").alias("bad"))
    # files that do not end in a closing bracket have a last segment that is no part of an array, so they are here too
    good = parsed.join(bad, ["source_ord", "path"], "left")
    good = good.filter(F.col("bad").isNull() | (F.lit(corrupt == "tail") & (F.col("segment") < F.col("bad"))))
    return (good.select("source_ord", "path", "segment", F.posexplode("items").alias("place", "v"))
            .select("source_ord", "path", (F.col("segment") + F.col("place")).alias("offset"), "v"))


def known_ranges(pieces: DataFrame) -> DataFrame:
    return pieces.select(*RANGE).distinct()
