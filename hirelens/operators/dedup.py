"""De-duplication.

D1  exact: md5 signature; the first row (smallest ``input_seq``) of each signature
    survives.  ``groupBy(sig).min(seq)`` combines map-side, so a signature holding a third
    of all rows never lands whole in one task (a window over ``sig`` would); the later
    copies, usually few, leave by an anti-join on ``seq``.
D2  pair similarity: mean of ``difflib.SequenceMatcher(None, later, earlier).ratio()``
    over lower-cased title and description, in an Arrow UDF applied to candidate
    pairs only.  Argument order matters (autojunk makes the ratio asymmetric).
D3  greedy near-duplicate removal: a row is dropped iff it is similar (> threshold)
    to an earlier *kept* row.  Exact, via
      1. collapse of identical (title, description) pairs (the copy's fate equals the first's);
     2. lossless candidates: per field the ratio is at most ``2*min/sum`` of the lengths and
        at most ``2*|a & b|/sum`` of the character multisets; the mean of the fields' bounds
        must exceed the threshold.  A mean above t needs each field above 2t-1, hence a
        length quotient above (2t-1)/(3-2t): rows lie in length cells of that base and meet
        those of neighbouring cells only (one cell for t <= 0.5).  A cell is cut into blocks of about
        ``block_rows`` rows or ``BLOCK_BYTES``, each a row of a written table with its texts.  That table meets
        itself in a nested loop, so nothing is shuffled: what is written grows with the rows, not with the pairs;
     3. in the same task a pair of blocks is compared as a matrix, and on the survivors the length of the longest common subsequence bounds difflib's ratio (bit-parallel, a
        fraction of difflib's time); difflib on what is left;
     4. resolution in rounds over the rows that have an edge (checkpointed each round).
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from hirelens.functions.text import col_
from hirelens.session import checkpoint_dir, scratch_path

# ---------------------------------------------------------------- D1


def signature(cols=("title", "description", "url")) -> Column:
    """md5 over ``lower(strip(field))`` joined by '|'; a null field counts as ''."""
    from hirelens.functions.text import py_strip

    parts = [py_strip(F.lower(F.coalesce(col_(c).cast("string"), F.lit("")))) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def dedup_exact(df: DataFrame, cols=("title", "description", "url"), seq: str = "input_seq") -> DataFrame:
    """Keep the first row of every signature."""
    # Dealt once by signature and row, so that both uses read the same exchange and ``df`` is not computed again for the
    # second; a frequent signature is spread.  Rows without ``seq`` are no copies.
    sigs = df.select(signature(cols).alias("_sig"), F.col(seq)).filter(F.col(seq).isNotNull()).repartition("_sig", seq)
    firsts = sigs.groupBy("_sig").agg(F.min(seq).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    later = sigs.join(firsts, "_sig").filter(F.col(seq) != F.col("_first")).select(seq)
    return df.join(later, seq, "left_anti")


# ---------------------------------------------------------------- D2

#: From this length of the second text on, difflib starts no block at its popular characters.
AUTOJUNK = 200


def _ratio(a: str, b: str) -> float:
    """``SequenceMatcher(None, a, b).ratio()``."""
    from difflib import SequenceMatcher

    # equal texts: difflib's blocks are the whole text
    if a == b:
        return 1.0
    return SequenceMatcher(None, a, b).ratio() if len(b) < AUTOJUNK else 2.0 * _matched(a, b) / (len(a) + len(b))


def _matched(a: str, b: str) -> int:
    """The characters in difflib's matching blocks, for a ``b`` of AUTOJUNK characters or more.

    difflib's steps, but for the places of ``a`` whose character is popular in ``b``, or not in it: these begin no block and
    end any run, so the search for the longest block passes over them.  In a long text they are nearly all.
    """
    places: dict[str, list[int]] = {}
    for j, c in enumerate(b):
        places.setdefault(c, []).append(j)
    most = len(b) // 100 + 1
    places = {c: js for c, js in places.items() if len(js) <= most}
    starts = [i for i, c in enumerate(a) if c in places]
    total, todo = 0, [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        i, j, size, runs, last = alo, blo, 0, {}, -2
        for at in starts[bisect_left(starts, alo):bisect_left(starts, ahi)]:
            before, runs = runs if at == last + 1 else {}, {}
            own = places[a[at]]
            for to in own[bisect_left(own, blo):bisect_left(own, bhi)]:
                k = runs[to] = before.get(to - 1, 0) + 1
                if k > size:
                    i, j, size = at - k + 1, to - k + 1, k
            last = at
        while i > alo and j > blo and a[i - 1] == b[j - 1]:
            i, j, size = i - 1, j - 1, size + 1
        while i + size < ahi and j + size < bhi and a[i + size] == b[j + size]:
            size += 1
        if size:
            total += size
            if alo < i and blo < j:
                todo.append((alo, i, blo, j))
            if i + size < ahi and j + size < bhi:
                todo.append((i + size, ahi, j + size, bhi))
    return total


@pandas_udf(T.DoubleType())
def pair_similarity(t_later: pd.Series, t_earlier: pd.Series,
                    d_later: pd.Series, d_earlier: pd.Series) -> pd.Series:
    """(title ratio + description ratio) / 2 of lower-cased text, later row first."""
    out = []
    for a, b, c, d in zip(t_later, t_earlier, d_later, d_earlier):
        a = "" if a is None else str(a).lower()
        b = "" if b is None else str(b).lower()
        c = "" if c is None else str(c).lower()
        d = "" if d is None else str(d).lower()
        out.append((_ratio(a, b) + _ratio(c, d)) / 2)
    return pd.Series(out, dtype="float64")


def char_masks(a: str) -> dict[str, int]:
    """For each character of ``a`` the number whose bits are its places."""
    if not a:
        return {}
    cp = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds, which = np.unique(cp, return_inverse=True)
    return {chr(c): int.from_bytes(np.packbits(which == k, bitorder="little").tobytes(), "little") for k, c in enumerate(kinds.tolist())}


def ratio_bound(a: str, b: str, least: float = 0.0, masks: dict[str, int] | None = None) -> float:
    """The ratio of the longest common subsequence, 2 * LCS / (len(a) + len(b)): never below difflib's ratio, whose
    matching blocks are a common subsequence.  A bound that is found to be at most ``least`` may be returned early.

    Bit-parallel: one bit per character of ``a`` (of the shorter text unless ``masks``, the :func:`char_masks` of ``a``, are
    given), a few operations on a long integer per character of the other.
    """
    if masks is None:
        if len(a) > len(b):
            a, b = b, a
        masks = char_masks(a)
    total = len(a) + len(b)
    if not total:
        return 1.0
    full = (1 << len(a)) - 1
    state, bound = full, 2.0 * min(len(a), len(b)) / total
    for at in range(0, len(b), 64):
        for hit in map(masks.get, b[at:at + 64]):
            if hit:
                # bits beyond the text, one more a character at most, never come back
                hit &= state
                state = (state + hit) | (state ^ hit)
        state &= full
        if at % 256 == 192:
            # what is matched so far, and at best every character that is left
            bound = 2.0 * min(len(a), len(a) - state.bit_count() + max(0, len(b) - at - 64)) / total
            if bound <= least:
                return bound
    return min(bound, 2.0 * (len(a) - state.bit_count()) / total)


def similarity_above(a: str, b: str, c: str, d: str, threshold: float, bounds=(ratio_bound, ratio_bound)) -> float | None:
    """D2 of lower-cased texts (titles, then descriptions, later first) where it is above the threshold, else None; most other pairs end at a bound.
    ``bounds``: :func:`ratio_bound` of titles and of descriptions, or what equals it."""
    # bounds by common subsequences first (the mean rises with either, rounded as it is)
    most = bounds[0](a, b, 2 * threshold - 1 - 1e-9) if a != b else 1.0
    if (most + 1.0) / 2 <= threshold:
        return None
    other = bounds[1](c, d, 2 * threshold - most - 1e-9) if c != d else 1.0
    if (most + other) / 2 <= threshold:
        return None
    rt = _ratio(a, b)
    if (rt + other) / 2 <= threshold:
        return None
    both = (rt + _ratio(c, d)) / 2
    return both if both > threshold else None


def _low(x) -> str:
    return "" if x is None else str(x).lower()


def _similar_factory(threshold: float):
    @pandas_udf(T.DoubleType())
    def similar(t_later: pd.Series, t_earlier: pd.Series, d_later: pd.Series, d_earlier: pd.Series) -> pd.Series:
        """D2 where it is above the threshold, else null."""
        low = [[_low(x) for x in s] for s in (t_later, t_earlier, d_later, d_earlier)]
        return pd.Series([similarity_above(*x, threshold) for x in zip(*low)], dtype="float64")

    # the filter on its result must not be pushed below, where it would run a second time
    return similar.asNondeterministic()


# ---------------------------------------------------------------- D3 features

def _bucket_table() -> np.ndarray:
    """Character buckets for the multiset bound: a-z, 0-9, space, '.', ',' and the
    Latin-1 lower-case letters each own a bucket; every other character shares one.
    Merging characters only raises ``sum(min)``, so the bound stays an upper bound."""
    own = list(range(ord("a"), ord("z") + 1)) + list(range(ord("0"), ord("9") + 1)) + \
        [ord(" "), ord("."), ord(",")] + list(range(0xDF, 0x100))
    lut = np.full(0x100, len(own), dtype=np.int64)
    for i, cp in enumerate(own):
        lut[cp] = i
    return lut


_LUT = _bucket_table()
N_BUCKETS = int(_LUT.max()) + 1


def _counts(s) -> np.ndarray:
    s = "" if s is None else str(s).lower()
    cp = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)
    idx = np.where(cp < 0x100, _LUT[np.minimum(cp, 0xFF)], N_BUCKETS - 1)
    return np.bincount(idx, minlength=N_BUCKETS).astype(np.int32)


@pandas_udf(T.StructType([T.StructField("lt", T.IntegerType()), T.StructField("ld", T.IntegerType()),
                          T.StructField("bag", T.BinaryType())]))
def _features(title: pd.Series, desc: pd.Series) -> pd.DataFrame:
    """Lengths and character counts (title's, then description's) of the lower-cased fields."""
    t, d = [_counts(x) for x in title], [_counts(x) for x in desc]
    return pd.DataFrame({"lt": [int(x.sum()) for x in t], "ld": [int(x.sum()) for x in d],
                         "bag": [np.concatenate(p).tobytes() for p in zip(t, d)]})


def _udf_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * 2)


def cell_base(threshold: float) -> float | None:
    """Quotient of two lengths that can be similar at all; None: any."""
    return (3 - 2 * threshold) / (2 * threshold - 1) * (1 + 1e-9) if threshold > 0.5 else None


def _band(length: Column, base: float | None) -> Column:
    """Length cell: lengths that can be similar lie in the same or adjacent ones (-1: empty)."""
    if base is None:
        return F.lit(0)
    empty = F.lit(-2)  # an empty field is similar to an empty one only
    return F.when(length <= 0, empty).otherwise(F.floor(F.log(length.cast("double")) / math.log(base) + 1e-12).cast("int"))


def _bound(la, lb, common):
    total = la + lb
    return np.where(total == 0, 1.0, 2.0 * common / np.maximum(total, 1))


#: Texts of a block, about (a longer text is a block of its own).
BLOCK_BYTES = 1 << 20
#: Pairs of blocks handed to Python at once.
BLOCK_PAIRS = 8
BLOCK = ["bt", "bd", "i", "seq", "lt", "ld", "twice", "bag", "title", "description"]


def _block_edges(threshold: float):
    """The similar pairs of each pair of blocks (columns ``a_*`` and ``b_*``): later, earlier, similarity.  A pair with an id that
    repeats comes without similarity if the bounds allow one."""
    need = 2.0 * threshold - 1e-9

    def one(r) -> pd.DataFrame:
        seq, other = np.asarray(r.a_seq), np.asarray(r.b_seq)
        lt, ld = (np.asarray(x, dtype=np.int64)[:, None] for x in (r.a_lt, r.a_ld))
        rt, rd = (np.asarray(x, dtype=np.int64)[None, :] for x in (r.b_lt, r.b_ld))
        ok = _bound(lt, rt, np.minimum(lt, rt)) + _bound(ld, rd, np.minimum(ld, rd)) > need
        itself = (r.a_bt, r.a_bd, r.a_i) == (r.b_bt, r.b_bd, r.b_i)
        ok &= seq[:, None] < other[None, :] if itself else seq[:, None] != other[None, :]
        i, j = np.nonzero(ok)
        bags = [np.frombuffer(b"".join(x), np.int32).reshape(len(x), -1) for x in (r.a_bag, r.b_bag)]
        keep = np.zeros(len(i), dtype=bool)
        for at in range(0, len(i), 50_000):
            a, b = i[at:at + 50_000], j[at:at + 50_000]
            both = np.minimum(bags[0][a], bags[1][b])
            keep[at:at + 50_000] = (_bound(lt[a, 0], rt[0, b], both[:, :N_BUCKETS].sum(axis=1))
                                    + _bound(ld[a, 0], rd[0, b], both[:, N_BUCKETS:].sum(axis=1))) > need
        # texts by row, their numbers (copies share one), and what pairs of numbers gave
        out, low, numbers, known = [], {}, {}, {}

        def text(side, row):
            if (side, row) not in low:
                own = (_low(r.a_title[row]), _low(r.a_description[row])) if side == 0 else (_low(r.b_title[row]), _low(r.b_description[row]))
                low[side, row] = own, numbers.setdefault(own, len(numbers))
            return low[side, row]

        def bounds(row):
            """The bounds by the masks of one row of the first block, made when first asked for."""
            own = {}

            def bound(field):
                def against(p, q, least):
                    mine = text(0, row)[0][field]
                    if field not in own:
                        own[field] = char_masks(mine)
                    return ratio_bound(mine, q if p is mine else p, least, own[field])
                return against
            return bound(0), bound(1)

        now, by = -1, None
        for x, y in zip(i[keep].tolist(), j[keep].tolist()):
            if x != now:  # pairs come by row of the first block
                now, by = x, bounds(x)
            (late, lr), (early, er) = ((0, x), (1, y)) if seq[x] > other[y] else ((1, y), (0, x))
            ids = max(int(seq[x]), int(other[y])), min(int(seq[x]), int(other[y]))
            if r.a_twice[x] or r.b_twice[y]:
                out.append((*ids, None))
                continue
            ((lt_, ld_), m), ((et, ed), n) = text(late, lr), text(early, er)
            if (m, n) not in known:
                known[m, n] = similarity_above(lt_, et, ld_, ed, threshold, by)
            s = known[m, n]
            if s is not None:
                out.append((*ids, s))
        return pd.DataFrame(out, columns=["l_seq", "e_seq", "similarity"]).astype({"l_seq": "int64", "e_seq": "int64", "similarity": "float64"})

    def edges(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                yield one(r)

    return edges


def exact_edges(reps: DataFrame, threshold: float = 0.9, seq: str = "input_seq",
                title: str = "title", description: str = "description", block_rows: int = 512) -> DataFrame:
    """(l_seq, e_seq, similarity) of the similar pairs, later -> earlier; lossless at any threshold: a similar pair always passes the
    bounds, and its rows lie in neighbouring length cells."""
    spark, base, root = reps.sparkSession, cell_base(threshold), scratch_path(reps.sparkSession, f"edges-{uuid.uuid4().hex}")
    # Python work is CPU-bound while its input is small in bytes: give it an explicit
    # partition count (AQE never coalesces an explicit repartition).
    parts = _udf_partitions(reps)
    feats = (reps.select(F.col(seq).alias("seq"), F.col(title).alias("title"), F.col(description).alias("description")).filter("seq is not null")
             .repartition(parts, "seq").select("*", _features(F.col("title"), F.col("description")).alias("f"))
             .select("seq", "title", "description", "f.*")
             .withColumn("bt", _band(F.col("lt"), base)).withColumn("bd", _band(F.col("ld"), base)))
    # Written to the shared checkpoint folder: all uses read it, the UDF runs once.
    feats = _written(feats, f"{root}/rows")
    size = F.coalesce(F.octet_length("title"), F.lit(0)) + F.coalesce(F.octet_length("description"), F.lit(0)) + F.octet_length("bag")
    # One row per populated cell: at most (log max length + 2)^2 rows whatever the data
    # volume, so broadcasting them is bounded.
    cells = (feats.groupBy("bt", "bd").agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("bytes"))
             .select("bt", "bd", F.greatest(F.ceil(F.col("n") / F.lit(block_rows)), F.ceil(F.col("bytes") / F.lit(BLOCK_BYTES))).cast("int").alias("blocks")))
    twice = feats.groupBy("seq").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("seq", F.lit(True).alias("twice"))
    rows = (feats.join(twice, "seq", "left").join(F.broadcast(cells), ["bt", "bd"])
            .withColumn("twice", F.coalesce("twice", F.lit(False))).withColumn("i", F.pmod(F.xxhash64("seq"), F.col("blocks")).cast("int")))
    packed = (rows.repartition(parts, "bt", "bd", "i").groupBy("bt", "bd", "i").agg(F.collect_list(F.struct(*BLOCK[3:])).alias("r"))
              .select("bt", "bd", "i", *[F.col(f"r.{c}").alias(c) for c in BLOCK[3:]]))
    packed = _written(packed, f"{root}/blocks")
    a, b = (packed.select(*[F.col(c).alias(f"{s}_{c}") for c in BLOCK]) for s in "ab")
    at, ad, zt, zd = (F.col(c) for c in ("a_bt", "a_bd", "b_bt", "b_bd"))
    # each pair of cells and each pair of blocks of a cell once
    order = (at < zt) | ((at == zt) & (ad < zd)) | ((at == zt) & (ad == zd) & (F.col("a_i") <= F.col("b_i")))
    # more, smaller tasks: long texts make some pairs of blocks far slower than others
    a = a.repartition(4 * spark.sparkContext.defaultParallelism)
    met = a.hint("shuffle_replicate_nl").join(b, (F.abs(at - zt) <= 1) & (F.abs(ad - zd) <= 1) & order)
    with _batches(spark, BLOCK_PAIRS):
        found = _written(met.mapInPandas(_block_edges(threshold), "l_seq bigint, e_seq bigint, similarity double"), f"{root}/edges")
    # ids that repeat: every pairing of their rows
    again = found.filter("similarity is null").select("l_seq", "e_seq")
    return found.filter("similarity is not null").unionByName(_checked(again, feats, threshold, "seq", "title", "description"))


def _checked(cand: DataFrame, rows: DataFrame, threshold: float, seq: str, title: str, description: str) -> DataFrame:
    """Candidate pairs by id with their similarity, those above the threshold."""
    txt = rows.select(F.col(seq), F.col(title), F.col(description))
    lt = txt.select(F.col(seq).alias("l_seq"), F.col(title).alias("l_t"), F.col(description).alias("l_d"))
    et = txt.select(F.col(seq).alias("e_seq"), F.col(title).alias("e_t"), F.col(description).alias("e_d"))
    # Spread the Python work evenly: candidates are few but texts can be long.
    pairs = cand.join(lt, "l_seq").join(et, "e_seq").repartition(_udf_partitions(rows), "l_seq", "e_seq")
    sim = _similar_factory(threshold)
    return pairs.select("l_seq", "e_seq", sim("l_t", "e_t", "l_d", "e_d").alias("similarity")).filter(F.col("similarity").isNotNull())


@contextmanager
def _batches(spark, rows: int):
    """Arrow batches of ``rows`` records meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lsh_pairs(reps: DataFrame, seq: str = "input_seq", title: str = "title", description: str = "description",
              tables: int = 24, max_distance: float = 0.6, gram: int = 5) -> DataFrame:
    """(later, earlier) candidates by MinHash over the texts' character grams.

    Opt-in and LOSSY: a pair whose gram sets have a Jaccard distance above
    ``max_distance``, or that shares none of the ``tables`` minima, is not found (at a
    distance d a pair is missed with probability d ** tables).  Its cost grows with the
    candidates, not with the pairs of a length cell.
    """
    from pyspark.ml.feature import HashingTF, MinHashLSH

    text = F.concat_ws("\u0001", F.lower(F.coalesce(F.col(title), F.lit(""))), F.lower(F.coalesce(F.col(description), F.lit(""))))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("_t") - (gram - 1))), lambda i: F.substr("_t", i, F.lit(gram)))
    rows = reps.select(F.col(seq).alias("seq"), text.alias("_t")).select("seq", F.array_distinct(grams).alias("_g"))
    vectors = HashingTF(inputCol="_g", outputCol="_v", numFeatures=1 << 20, binary=True).transform(rows).select("seq", "_v")
    model = MinHashLSH(inputCol="_v", outputCol="_h", numHashTables=tables, seed=11).fit(vectors)
    close = model.approxSimilarityJoin(vectors, vectors, max_distance, "_d")
    return (close.filter(F.col("datasetA.seq") > F.col("datasetB.seq"))
            .select(F.col("datasetA.seq").alias("l_seq"), F.col("datasetB.seq").alias("e_seq")))


def similar_edges(reps: DataFrame, threshold: float = 0.9, seq: str = "input_seq",
                  title: str = "title", description: str = "description", block_rows: int = 512,
                  candidates: str = "exact") -> DataFrame:
    """(l_seq, e_seq, similarity) of pairs, later -> earlier, with similarity (D2) > threshold; ``candidates``:
    ``exact`` (lossless bounds) or ``lsh`` (lossy, for inputs beyond pairwise comparison)."""
    if candidates not in ("exact", "lsh"):
        raise ValueError(candidates)
    if candidates == "exact":
        return exact_edges(reps, threshold, seq, title, description, block_rows)
    return _checked(lsh_pairs(reps, seq, title, description), reps, threshold, seq, title, description)


def dropped_greedy(edges: DataFrame) -> DataFrame:
    """Ids dropped under the sequential rule "drop iff similar to an earlier kept row".

    Only rows on an edge take part; all others are kept.  Round: an undecided row with a
    kept earlier neighbour is dropped; one whose earlier neighbours are all dropped is
    kept.  The earliest undecided row always resolves, so the loop ends; each round's
    state is checkpointed (lineage cut).
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    e = edges.select(F.col("l_seq").alias("id"), F.col("e_seq").alias("dst")).checkpoint()
    later = e.select("id").distinct()
    known = e.select(F.col("dst").alias("id")).distinct().join(later, "id", "left_anti").withColumn("st", F.lit("K")).checkpoint()
    open_ = later.checkpoint()
    while open_.limit(1).count() > 0:
        state = e.join(open_, "id", "left_semi").join(known.select(F.col("id").alias("dst"), "st"), "dst", "left")
        verdict = (state.groupBy("id")
                   .agg(F.max(F.coalesce(F.col("st") == "K", F.lit(False))).alias("any_k"),
                        F.min(F.coalesce(F.col("st") == "D", F.lit(False))).alias("all_d"))
                   .select("id", F.when(F.col("any_k"), "D").when(F.col("all_d"), "K").otherwise("U").alias("st"))).checkpoint()
        known = known.unionByName(verdict.filter("st != 'U'"))
        open_ = verdict.filter("st = 'U'").select("id")
    return known.filter("st = 'D'").select("id")


def dedup_near(df: DataFrame, threshold: float = 0.9, seq: str = "input_seq",
               title: str = "title", description: str = "description", block_rows: int = 512,
               candidates: str = "exact") -> DataFrame:
    """D3: rows of ``df`` kept by the greedy first-wins near-duplicate rule."""
    checkpoint_dir(df.sparkSession)
    key = F.concat_ws("|", F.md5(F.coalesce(F.col(title), F.lit(""))), F.md5(F.coalesce(F.col(description), F.lit(""))))
    keyed = df.select(key.alias("_k"), F.col(seq)).checkpoint()
    firsts = keyed.groupBy("_k").agg(F.min(seq).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    copies = keyed.join(firsts, "_k").filter(F.col(seq) != F.col("_first")).select(seq)
    reps = df.select(seq, title, description).join(copies, seq, "left_anti")
    edges = similar_edges(reps, threshold, seq, title, description, block_rows, candidates)
    gone = copies.unionByName(dropped_greedy(edges).select(F.col("id").alias(seq)))
    return df.join(gone, seq, "left_anti")
