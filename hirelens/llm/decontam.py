"""Operator 2, benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

A document is contaminated by an item if some passage of it lies within k word edits of the
item's words, k = floor(0.2 n) for n words (lowered so that n / (k + 1) is at least 3; items of
fewer than 6 words must be there word by word).

* Windows.  k edits leave one of k + 1 disjoint pieces of the item whole, so only item-sized
  windows that could hold such a piece at its place (shifted by up to k) are looked at: nothing
  is lost by this.
* CGK embedding.  A walk over a window's words writes the current word at each of 2 n steps and
  moves on by a random bit of (step, word).  Windows at small edit distance meet again in the
  walk and then agree in most of the places.
* Bit sampling.  Each of ``TABLES`` hash tables takes ``SAMPLE`` places of one of ``WALKS``
  independent walks; windows and items of equal key and size are candidates.  The tests measure
  the recall of edited passages (at least 0.95 at the full k edits).
* Candidates are confirmed by the edit distance between the item and the best-fitting passage
  around the window.

The documents are read once for each block of items and never shuffled.  A block has about
``BLOCK_CHARS`` characters of items, which bounds the broadcast; a larger benchmark has more.

Defined results: words are runs of letters, digits and underscores of the lower-cased text; null
or empty texts and items without words match nothing; items of equal words are all reported;
repeated rows are reported once for each row; empty tables match nothing; other columns are
ignored by :func:`matches` and kept by :func:`clean`.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import claim, ready, table

RATE = 0.2
MIN_PIECE = 3
WALKS = 12
TABLES = 72
SAMPLE = 3
BLOCK_CHARS = 4_000_000
WINDOWS_AT_ONCE = 20_000

_words = re.compile(r"\w+").findall
_U = np.uint64


def words_of(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def edits_of(n: int) -> int:
    return max(0, min(int(RATE * n), n // MIN_PIECE - 1))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Finder:
    """The items of one block, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        by_words: dict[tuple[str, ...], list] = {}
        for item_id, text in items:
            w = tuple(words_of(text))
            if w:
                by_words.setdefault(w, []).append(item_id)
        self.ids = list(by_words.values())
        vocabulary = {w: i + 1 for i, w in enumerate(sorted({x for ws in by_words for x in ws}))}
        self.code = vocabulary.get
        self.n = np.array([len(w) for w in by_words], dtype=np.int64)
        self.k = np.array([edits_of(int(x)) for x in self.n], dtype=np.int64)
        self.width = int(self.n.max()) if len(self.n) else 0
        self.words = np.zeros((len(self.n), self.width), dtype=np.int64)
        for i, w in enumerate(by_words):
            self.words[i, :len(w)] = [vocabulary[x] for x in w]
        rng = np.random.default_rng(11)
        self.mul = rng.integers(1, 1 << 62, (WALKS, 2 * self.width), dtype=np.uint64) * _U(2) + _U(1)
        self.add = rng.integers(0, 1 << 62, (WALKS, 2 * self.width), dtype=np.uint64)
        self.place = rng.random((TABLES, SAMPLE))
        # pieces: for each length, the sorted hashes and what they stand for
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, (n, k) in enumerate(zip(self.n, self.k)):
            q = int(n // (k + 1))
            for j in range(int(k) + 1):
                found.setdefault(q, []).append((int(self._grams(self.words[i, j * q:(j + 1) * q], q)[0]), i, j * q))
        for q, rows in found.items():
            rows.sort()
            self.pieces[q] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]),
                              np.array([r[2] for r in rows]))
        self.bits = {q: self._bitmap(p[0]) for q, p in self.pieces.items()}
        self.tables = []
        if len(self.n):
            for keys in self._keys(self.words, self.n):
                order = np.argsort(keys, kind="stable")
                self.tables.append((keys[order], order))

    @staticmethod
    def _bitmap(hashes: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(hashes >> _U(44)).astype(np.int64)] = True
        return bits

    @staticmethod
    def _grams(codes: np.ndarray, q: int) -> np.ndarray:
        c = codes.astype(np.uint64)
        h = c[:len(c) - q + 1].copy()
        for i in range(1, q):
            h = h * _U(0x9E3779B97F4A7C15) + c[i:len(c) - q + 1 + i]
        return _mix(h + _U(q))

    def _keys(self, windows: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """For each table the keys of the windows (rows padded with 0 after n words)."""
        rows, last = np.arange(len(windows)), n - 1
        pad = _U(0xFFFFFFFF)
        out = []
        per = TABLES // WALKS
        for walk in range(WALKS):
            at = np.zeros(len(windows), dtype=np.int64)
            written = np.empty((len(windows), 2 * self.width), dtype=np.uint64)
            for t in range(2 * self.width):
                w = windows[rows, np.minimum(at, last)].astype(np.uint64)
                w = np.where(at > last, pad, w)
                written[:, t] = w
                at += (_mix(w * self.mul[walk, t] + self.add[walk, t]) >> _U(63)).astype(np.int64)
            for j in range(walk * per, (walk + 1) * per):
                h = n.astype(np.uint64) * _U(TABLES) + _U(j)
                for u in self.place[j]:
                    h = _mix(h * _U(0x9E3779B97F4A7C15) + written[rows, (u * 2 * n).astype(np.int64)])
                out.append(h)
        return out

    def starts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item size) of the windows of one text that can hold a whole piece."""
        starts, sizes = [], []
        for q, (hashes, item, offset) in self.pieces.items():
            if len(codes) < q:
                continue
            h = self._grams(codes, q)
            maybe = np.flatnonzero(self.bits[q][(h >> _U(44)).astype(np.int64)])
            lo, hi = np.searchsorted(hashes, h[maybe], "left"), np.searchsorted(hashes, h[maybe], "right")
            for p, a, b in zip(maybe[hi > lo], lo[hi > lo], hi[hi > lo]):
                for r in range(a, b):
                    k = int(self.k[item[r]])
                    s = np.arange(p - offset[r] - k, p - offset[r] + k + 1)
                    starts.append(s)
                    sizes.append(np.full(len(s), self.n[item[r]]))
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.stack([np.concatenate(starts), np.concatenate(sizes)]), axis=1)
        return both[0], both[1]

    def confirm(self, codes: list[np.ndarray], doc: np.ndarray, start: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least word edits between each item and a passage around the window; where it ends."""
        n, k = self.n[item], self.k[item]
        span = int((n + 4 * k).max())
        text = np.full((len(doc), span), -1, dtype=np.int64)
        first = np.maximum(0, start - 2 * k)
        for r in range(len(doc)):
            c = codes[doc[r]][first[r]:int(start[r] + n[r] + 2 * k[r])]
            text[r, :len(c)] = c
        place = np.arange(span + 1)
        row = np.zeros((len(doc), span + 1), dtype=np.int64)
        best, end = np.full(len(doc), 1 << 30, dtype=np.int64), np.zeros(len(doc), dtype=np.int64)
        for i in range(int(n.max())):
            new = np.empty_like(row)
            new[:, 0] = i + 1
            np.minimum(row[:, 1:] + 1, row[:, :-1] + (text != self.words[item, i][:, None]), out=new[:, 1:])
            row = np.minimum.accumulate(new - place, axis=1) + place
            done = n == i + 1
            if done.any():
                end[done] = row[done].argmin(axis=1)
                best[done] = row[done, end[done]]
        return best, first + end

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, word after the passage) for each item found in each text."""
        if not self.width:
            return []
        code, codes, wins = self.code, [], []
        for d, t in enumerate(texts):
            c = np.array([code(w, 0) for w in words_of(t)], dtype=np.int64)
            codes.append(c)
            s, n = self.starts(c) if len(c) else (np.zeros(0, np.int64),) * 2
            if len(s):
                wins.append((np.full(len(s), d), s, n))
        if not wins:
            return []
        doc, start, n = (np.concatenate(x) for x in zip(*wins))
        out: dict[tuple[int, int], tuple[int, int]] = {}
        for i in range(0, len(doc), WINDOWS_AT_ONCE):
            self._find(codes, doc[i:i + WINDOWS_AT_ONCE], start[i:i + WINDOWS_AT_ONCE], n[i:i + WINDOWS_AT_ONCE], out)
        return [(d, i, e, s) for (d, i), (e, s) in sorted(out.items())]

    def _find(self, codes, doc, start, n, out) -> None:
        windows = np.zeros((len(doc), self.width), dtype=np.int64)
        for r in range(len(doc)):
            c, s = codes[doc[r]], int(start[r])
            part = c[max(0, s):max(0, s + int(n[r]))]
            windows[r, max(0, -s):max(0, -s) + len(part)] = part
        pairs = []
        for (keys, order), own in zip(self.tables, self._keys(windows, n)):
            lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            hit = np.flatnonzero(hi > lo)
            for width in range(int((hi - lo).max()) if len(hit) else 0):
                more = hit[hi[hit] - lo[hit] > width]
                pairs.append(np.stack([more, order[lo[more] + width]]))
        if not pairs:
            return
        r, item = np.unique(np.concatenate(pairs, axis=1), axis=1)
        edits = (windows[r] != self.words[item]).any(axis=1).astype(np.int64)  # 0: word by word the same
        end = start[r] + n[r]
        for i in range(0, len(r), WINDOWS_AT_ONCE // 4):
            part = np.flatnonzero(edits[i:i + WINDOWS_AT_ONCE // 4]) + i
            if len(part):
                edits[part], end[part] = self.confirm(codes, doc[r[part]], start[r[part]], item[part])
        for x in np.flatnonzero(edits <= self.k[item]):
            key = (int(doc[r[x]]), int(item[x]))
            got = (int(edits[x]), int(end[x]))
            if key not in out or got < out[key]:
                out[key] = got


def blocks(benchmark: DataFrame):
    """The items in blocks of about BLOCK_CHARS characters, fetched one after the other."""
    b = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    chars = b.agg(F.sum(F.length("text")).alias("c")).first().c or 0
    n = -(-chars // BLOCK_CHARS)
    for i in range(n):
        yield [(r.item_id, r.text) for r in b.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == i).collect()]


_FINDERS: dict[int, Finder] = {}


def _finder(bc) -> Finder:
    claim("decontam", _FINDERS.clear)
    key = bc.value[0]
    if key not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[key] = Finder(bc.value[1])
    return _FINDERS[key]


def _broadcast(spark, items, i: int):
    return spark.sparkContext.broadcast((f"{uuid.uuid4().hex}-{i}", items))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, item_words, end_word (the place after the passage): each item found in each
    row of ``docs``."""
    spark = docs.sparkSession
    ready(spark)
    src = docs.select("doc_id", "text")
    item_type = benchmark.schema["item_id"].dataType
    schema = T.StructType([src.schema["doc_id"], T.StructField("item_id", item_type), T.StructField("edits", T.IntegerType()),
                           T.StructField("item_words", T.IntegerType()), T.StructField("end_word", T.IntegerType())])
    out = spark.createDataFrame([], schema)
    for i, items in enumerate(blocks(benchmark)):
        bc = _broadcast(spark, items, i)

        def run(batches, bc=bc):
            f = _finder(bc)
            for b in batches:
                rows = [(d, x, e, int(f.n[it]), s) for d, it, e, s in f.find(b.column(1).to_pylist()) for x in f.ids[it]]
                cols = list(zip(*rows)) if rows else [()] * 5
                ids = b.column(0).take(pa.array(cols[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cols[1], pa.int64() if isinstance(item_type, T.LongType) else None),
                     *[pa.array(c, pa.int32()) for c in cols[2:]]], ["doc_id", "item_id", "edits", "item_words", "end_word"])

        out = out.unionByName(src.mapInArrow(run, schema))
    return out


def _found(bc):
    @F.arrow_udf("boolean")
    def found(texts: pa.Array) -> pa.Array:
        hit = np.zeros(len(texts), dtype=bool)
        hit[[d for d, *_ in _finder(bc).find(texts.to_pylist())]] = True
        return pa.array(hit)

    return found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows; nothing is shuffled."""
    spark = docs.sparkSession
    ready(spark)
    for i, items in enumerate(blocks(benchmark)):
        docs = docs.filter(~_found(_broadcast(spark, items, i))(F.col("text")))
    return docs


def op2(spark, sf_dir) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
