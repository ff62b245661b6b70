"""Operator 12, vector code compression: product codes whose nearest entries are found by Orchard's search.

Vectors become whole numbers (``floor(1024 x)``) and are cut into ``PARTS`` equal parts, each with
a codebook of at most ``ENTRIES`` entries.  The books start as the parts of the smallest ids and are
refined in ``ROUNDS`` rounds: every part goes to its nearest entry, every entry becomes the floor of
its parts' mean; an entry without parts stays.

Orchard's search: each entry has the list of all entries sorted by distance from it.  A search
holds one entry, walks its list, marks what it has seen, jumps to the list of an entry that is nearer
(of equal distance: lower index) and ends where the list is farther from its entry than twice the
distance found, since by the triangle inequality all beyond is farther than that.  All distances are
squared whole numbers, so that the end (four times the squared distance) and ties are exact.  Searches
of an Arrow batch run side by side; each step compares the next ``STRIDE`` entries of a list.

The books (bounded: PARTS x ENTRIES entries) are broadcast; sums and counts of entries are formed in
each task and added by Spark; only the new books come to the driver.  A round reads the written table
of whole-number vectors, so a lost executor costs its tasks.

Defined results: rows with a null vector or null or non-finite components are dropped; vectors that
are shorter than the longest are filled with zeros, as is a length that PARTS does not divide; null
ids come last, rows of equal id are ordered by vector; repeated rows each have their row; with fewer
than ENTRIES rows the books have that many entries; no kept rows give no rows.  Numbers too large for
64-bit distances are computed with Python's integers, components beyond +-10^27 count as that, an error
beyond 64 bits as the largest.  Columns with other names are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, claim, join_keyed, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
STRIDE = 16
LARGEST = 10 ** 27
#: Rows that search side by side; bounds the memory of a worker.
BLOCK = 2048


def finite(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows with only finite components."""
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    ok = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(F.col("vector").isNotNull() & F.coalesce(ok, F.lit(False)))


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE x): 64-bit where all distances fit, else Python's integers."""
    limit = LARGEST // SCALE
    scaled = np.floor(np.clip(values, -limit, limit) * SCALE)
    if values.size == 0 or np.abs(scaled).max() < 2 ** 24:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled.tolist()], dtype=object).reshape(values.shape)


def narrow(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in the smallest type that holds every squared distance between their rows."""
    top = max([int(np.abs(a).max()) if a.size else 0 for a in arrays])
    bound = (2 * top) ** 2 * max(arrays[0].shape[1], 1)
    kind = np.int32 if bound < 2 ** 31 else np.int64 if 4 * bound < 2 ** 63 else object
    return [a.astype(kind) for a in arrays]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(-1) if d.dtype == object else np.einsum("...i,...i->...", d, d)


class Book:
    """One part's codebook with the distance-sorted list of every entry."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k = len(entries)
        (e,) = narrow(entries)
        apart = np.array([squared(e, e[i]) for i in range(k)]).reshape(k, k)
        self.order = np.array([np.argsort(row, kind="stable") for row in apart], dtype=np.int64).reshape(k, k)
        self.apart = np.take_along_axis(apart, self.order, 1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each part's nearest entry (ties: lower index)."""
        q, e = narrow(parts, self.entries)
        n, k = len(q), len(e)
        apart = self.apart if q.dtype == object or self.apart.dtype == object else self.apart.astype(np.int64)
        best = np.zeros(n, dtype=np.int64)
        dist = squared(q, e[0]).astype(object if q.dtype == object else np.int64)
        at = np.ones(n, dtype=np.int64)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, 0] = True
        live = np.arange(n)
        ahead = np.arange(STRIDE)
        while live.size:
            b, d = best[live], dist[live]
            places = at[live][:, None] + ahead
            clipped = np.minimum(places, k - 1)
            # the list is sorted, so what passes is a prefix of the stride
            near = (places < k) & (apart[b[:, None], clipped] <= 4 * d[:, None])
            names = self.order[b[:, None], clipped]
            row, col = np.nonzero(near & ~seen[live[:, None], names])
            found = names[row, col]
            seen[live[row], found] = True
            got = squared(q[live[row]], e[found])
            far = got.max() + 1 if got.size else 0
            each = np.full(near.shape, max(far, d.max() + 1), dtype=d.dtype)
            each[row, col] = got
            least = each.min(1)
            index = np.where(each == least[:, None], names, k).min(1)
            jump = (least < d) | ((least == d) & (index < b))
            to = live[jump]
            best[to], dist[to], at[to] = index[jump], least[jump], 0
            on = ~jump & near[:, -1].astype(bool)
            at[live[on]] += STRIDE
            live = live[jump | on]
        return best, dist


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column as a matrix, short rows filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    if flat.size:
        row = np.repeat(np.arange(len(sizes)), sizes)
        col = np.arange(flat.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, col] = flat
    return out


def blocks(batches: Iterator[pa.RecordBatch], width: int):
    """(batch, whole-number matrix) in blocks of bounded size."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            yield part, whole(matrix(part.column("vector"), width))


def split(width: int) -> list[slice]:
    step = width // PARTS
    return [slice(p * step, (p + 1) * step) for p in range(PARTS)]


SUMS = "part int, entry int, at int, total decimal(38,0), n long"
CODES = "vec_id {id}, no_label boolean, label_key string, code string, error long"


def sums_of(kept: DataFrame, books, width: int) -> DataFrame:
    """part, entry, at (place in the part), total, n: sums of the parts at each entry, by Orchard's search in each task."""
    def run(batches):
        claim("codes")
        lists = [Book(b) for b in books.value]
        step = width // PARTS
        total = [np.zeros((len(b.entries), step), dtype=object) for b in lists]
        count = [np.zeros(len(b.entries), dtype=np.int64) for b in lists]
        for _, v in blocks(batches, width):
            for p, s in enumerate(split(width)):
                index, _ = lists[p].nearest(v[:, s])
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                total[p][used] += np.add.reduceat(v[order][:, s], first, axis=0).astype(object)
                count[p] += np.bincount(index, minlength=len(count[p]))
        import decimal
        rows = [(p, e, i, decimal.Decimal(int(x)), int(count[p][e])) for p in range(PARTS) for e in np.nonzero(count[p])[0].tolist()
                for i, x in enumerate(total[p][e])]
        cols = list(zip(*rows)) or [[]] * 5
        types = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["part", "entry", "at", "total", "n"])

    each = kept.select("vector").mapInArrow(run, SUMS)
    return each.groupBy("part", "entry", "at").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n"))


def train(kept: DataFrame, width: int) -> list[np.ndarray]:
    """The codebooks after ROUNDS rounds, one matrix of whole numbers for each part."""
    sc = kept.sparkSession.sparkContext
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    start = whole(np.array([r.vector + [0.0] * (width - len(r.vector)) for r in first]).reshape(len(first), width))
    books = [start[:, s] for s in split(width)]
    for _ in range(ROUNDS if width else 0):
        sent = sc.broadcast(books)
        new = [b.astype(object) for b in books]
        for r in sums_of(kept, sent, width).collect():
            new[r.part][r.entry, r.at] = int(r.total) // r.n
        books = [b if b.size and max(abs(x) for x in b.flat) >= 2 ** 24 else b.astype(np.int64) for b in new]
        sent.unpersist()
    return books


def encode(kept: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """vec_id, no_label, label_key, code (two hex digits a part) and error of every kept row."""
    sent = kept.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        claim("codes")
        lists = [Book(b) for b in sent.value]
        for batch, v in blocks(batches, width):
            pairs = [lists[p].nearest(v[:, s]) for p, s in enumerate(split(width))]
            codes = ["".join(f"{i:02x}" for i in row) for row in zip(*[i.tolist() for i, _ in pairs])]
            errors = [min(sum(row), 2 ** 63 - 1) for row in zip(*[d.tolist() for _, d in pairs])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("vec_id", "no_label", "label_key")], pa.array(codes, pa.string()),
                                              pa.array(errors, pa.int64())], names=["vec_id", "no_label", "label_key", "code", "error"])

    keyed = kept.select("vec_id", F.col("label").isNull().alias("no_label"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label_key"), "vector")
    return keyed.mapInArrow(run, CODES.format(id=kept.schema["vec_id"].dataType.simpleString()))


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.flat).encode()).hexdigest()


def compress(vectors: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, code, error, label_error), and the codebooks."""
    scratch = Scratch(vectors.sparkSession, "codes")
    kept = scratch.write(finite(vectors), "kept")
    width = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width += -width % PARTS
    books = train(kept, width)
    coded = scratch.write(encode(kept, books, width), "coded")
    scratch.drop("kept")
    # a label's error may pass 64 bits only where single errors are near them
    sums = coded.groupBy("no_label", "label_key").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("t"), F.count("*").alias("n"))
    sums = scratch.write(sums.select("no_label", "label_key", F.least("t", F.lit(2 ** 63 - 1).cast("decimal(38,0)")).cast("long").alias("label_error"), "n"), "sums")
    out = join_keyed(coded, sums, ["no_label", "label_key"], "n")
    return out.select("vec_id", "code", "error", "label_error"), books


def op12(spark, sf_dir) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return coded.withColumn("codebooks_sha256", F.lit(digest(books)))


def _round(i: int) -> str:
    """SQL: nearest entries (a), their means (m) and the next books (b) of round i."""
    return f"""
a{i} AS MATERIALIZED (SELECT p.id, p.part, arg_min(b.e, (p.ss + b.ss - 2 * list_inner_product(p.s, b.s), b.e)) AS e
       FROM p JOIN b{i} b USING (part) GROUP BY p.id, p.part),
m{i} AS (SELECT part, e, place, floor(sum(x) / count(*)) AS x
       FROM (SELECT a.part, a.e, unnest(p.s) AS x, generate_subscripts(p.s, 1) AS place FROM a{i} a JOIN p USING (id, part)) GROUP BY ALL),
l{i} AS (SELECT part, e, list(x ORDER BY place) AS s FROM m{i} GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT part, e, s, list_inner_product(s, s) AS ss
       FROM (SELECT part, e, coalesce(l.s, b.s) AS s FROM b{i} b LEFT JOIN l{i} l USING (part, e))),"""


#: The same in DuckDB, nearest entries by comparing all (doubles hold these whole numbers exactly).
ORACLE = f"""
WITH kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS id,
       list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
       WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (SELECT id, part, s, list_inner_product(s, s) AS ss FROM (SELECT id, part,
       v[CAST(part * (len(v) // {PARTS}) + 1 AS BIGINT):CAST((part + 1) * (len(v) // {PARTS}) AS BIGINT)] AS s FROM kept, range({PARTS}) t(part))),
b0 AS MATERIALIZED (SELECT part, id - 1 AS e, s, ss FROM p WHERE id <= {ENTRIES}),{"".join(_round(i) for i in range(ROUNDS))}
f AS (SELECT p.id, p.part, arg_min(b.e, (p.ss + b.ss - 2 * list_inner_product(p.s, b.s), b.e)) AS e,
       min(p.ss + b.ss - 2 * list_inner_product(p.s, b.s)) AS d FROM p JOIN b{ROUNDS} b USING (part) GROUP BY p.id, p.part),
c AS (SELECT id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY id),
h AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, place)) AS codebooks_sha256
       FROM (SELECT part, e, unnest(s) AS x, generate_subscripts(s, 1) AS place FROM b{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN c USING (id), h
"""
