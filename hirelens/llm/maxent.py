"""Operator 7, LM scoring: a hashed maximum-entropy model with class-factored softmax.

log P(word | history) = log P(class | history) + log P(word | class)

* A word's class: one each for the ``SINGLES`` most frequent words and for the end of a text, else
  one of ``GROUPS`` by its last two bytes.
* P(class | history) is a softmax over hashed features of the history: the previous word
  (bigram), the previous two classes (trigram), and two skip features (the classes two and three
  back; the word two back).  Weights: buckets x classes.
* P(word | class) is the closed-form optimum of a softmax with word features only, smoothed:
  (c + 0.5) / (n + 0.5 (v + 1)) with the class's tokens n and distinct words v; words that were
  never seen share the class's extra 0.5.

Training takes all tokens of all training texts once, in ``ROUNDS`` rounds.  A round's texts are dealt to
parts by a hash of id and text; each part makes mini-batch gradient steps from the weights of the round
before (step sizes fall with the square root of a bucket's use), and the parts' weights are averaged by
use, in two levels, and sent out again.  The number of parts follows from the tokens alone (one for
``TOKENS_PER_PART``), texts are taken in hash order and sums in part order, so neither the number of cores
nor the files' layout changes a score.  The buckets double with the corpus, from 2^LEAST_BITS up to
2^MAX_BITS (the weights must fit into a worker), the counts grow with it without bound.

Word counts are exact over all training texts.  Those of the most frequent words (as many as fit
into ``HEAD_WORDS`` by a count threshold) are broadcast; every other word of a text is joined to the
count table by its 64-bit hash, so no word is dropped at any vocabulary size.

Scoring is one pass with sparse numpy batches: features are bucket numbers, never dense vectors.

Defined results: a null text is empty and has one token, its end; words are split at ASCII white
space after lower-casing A-Z; without training texts counts are 0 and classes equally likely; a
row without doc_id trains; repeated rows count as often as they come; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, claim, fold_of, table

SINGLES = 11
GROUPS = 20
CLASSES = SINGLES + 1 + GROUPS
END = SINGLES
#: Bits of a bucket number up to TOKENS_PER_TABLE tokens, and at most.
LEAST_BITS = 16
MAX_BITS = 20
TOKENS_PER_TABLE = 200_000_000
ROUNDS = 3
BATCH = 8192
RATE = 0.5
TOKENS_PER_PART = 2_000_000
HEAD_WORDS = 500_000
MAX_KNOWN = 500_000
MAX_COUNTED = 400_000
BLOCKS = 64
#: Characters of the texts that are turned into arrays at once (a longer text is taken alone).
READ_CHARS = 4_000_000

_U = np.uint64


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def key_of(word: bytes) -> int:
    """Signed 64-bit hash of a word."""
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def group_of(word: bytes) -> int:
    return SINGLES + 1 + zlib.crc32(word[-2:]) % GROUPS


# ---------------------------------------------------------------- counts

def word_counts(texts: DataFrame) -> DataFrame:
    """(key, grp, n) of all words; each task's table is emitted when it is full."""
    def run(batches):
        claim("maxent", _READERS.clear)
        counts: Counter = Counter()

        def table_():
            return pa.RecordBatch.from_arrays(
                [pa.array([key_of(w) for w in counts], pa.int64()), pa.array([group_of(w) for w in counts], pa.int32()),
                 pa.array(list(counts.values()), pa.int64())], ["key", "grp", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(words_of(t))
                if len(counts) >= MAX_COUNTED:
                    yield table_()
                    counts.clear()
        yield table_()

    return (texts.select("text").mapInArrow(run, "key long, grp int, n long")
            .groupBy("key").agg(F.first("grp").alias("grp"), F.sum("n").alias("n")))


class Counts:
    """What the workers need: head words (sorted by key), classes and totals."""

    def __init__(self, keys, n, groups, per_group: dict[int, tuple[int, int]], n_texts: int):
        order = np.argsort(keys, kind="stable")
        self.keys, self.n, cls = keys[order], n[order], groups[order].astype(np.int64)
        tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
        for g, (t, v) in per_group.items():
            tokens[g], distinct[g] = t, v
        top = np.lexsort((self.keys, -self.n))[:SINGLES]
        for c, i in enumerate(top):
            tokens[cls[i]] -= self.n[i]
            distinct[cls[i]] -= 1
            tokens[c], distinct[c] = self.n[i], 1
            cls[i] = c
        tokens[END], distinct[END] = n_texts, min(1, n_texts)
        self.cls, self.n_texts = cls.astype(np.uint8), n_texts
        self.total, self.distinct = int(tokens.sum()), int(distinct.sum())
        self.log_room = np.log10(tokens + 0.5 * (distinct + 1))


def counts_of(texts: DataFrame, scratch: Scratch) -> tuple[Counts, DataFrame]:
    table_ = scratch.write(word_counts(texts), "counts")
    n_texts = texts.count()
    sizes = table_.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    least, room = 1 << 62, HEAD_WORDS
    for r in sizes.toLocalIterator():  # distinct counts: far fewer than words
        if r.words > room:
            break
        least, room = r.n, room - r.words
    head = table_.filter(F.col("n") >= least).select("key", "n", "grp").toArrow()  # at most HEAD_WORDS rows
    per = {r.grp: (r.t, r.v) for r in table_.groupBy("grp").agg(F.sum("n").alias("t"), F.count("*").alias("v")).collect()}
    return Counts(*(head[c].to_numpy() for c in ("key", "n", "grp")), per, n_texts), table_


# ---------------------------------------------------------------- a worker's view of words

class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, w: bytes) -> int:
        n = self[w] = len(self)
        self.new.append(w)
        return n


class Reader:
    """Turns texts into arrays; remembers a bounded number of words between batches."""

    def __init__(self, counts: Counts):
        self.counts = counts
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers()
        self.cls, self.key = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tail, self.logs = np.zeros(0, bool), np.zeros(0)

    def _fill(self) -> None:
        """Class, key, tail and log10(c + 0.5) of the words numbered since the last call."""
        words, c = self.known.new, self.counts
        if not words:
            return
        key = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
        at = np.searchsorted(c.keys, key)
        head = at < len(c.keys)
        head[head] = c.keys[at[head]] == key[head]
        cls = np.fromiter(map(group_of, words), np.int64, len(words))
        cls[head] = c.cls[at[head]]
        logs = np.zeros(len(words))
        logs[head] = np.log10(c.n[at[head]] + 0.5)
        self.cls, self.key = np.concatenate([self.cls, cls]), np.concatenate([self.key, key])
        self.tail, self.logs = np.concatenate([self.tail, ~head]), np.concatenate([self.logs, logs])
        self.known.new = []

    def read(self, texts: list[str | None]):
        """(words' numbers, words of each text, classes and keys with an end after each text)."""
        if len(self.known) > MAX_KNOWN:
            self.clear()
        lists = [words_of(t) for t in texts]
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        num = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        self._fill()
        word = np.ones(len(num) + len(sizes), dtype=bool)
        word[np.cumsum(sizes + 1) - 1] = False
        cls, key = np.full(len(word), END, np.int64), np.zeros(len(word), np.int64)
        cls[word], key[word] = self.cls[num], self.key[num]
        return num, sizes, cls, key


def pieces(texts: list[str | None]):
    """Runs (first, last) of texts that hold about READ_CHARS characters together."""
    first = held = 0
    for i, t in enumerate(texts):
        if i > first and held + len(t or "") > READ_CHARS:
            yield first, i
            first, held = i, 0
        held += len(t or "")
    if len(texts) > first:
        yield first, len(texts)


def features(sizes: np.ndarray, cls: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    """Bucket numbers (4 x tokens) of the history within each text (``sizes`` without the ends)."""
    texts = len(sizes)
    at = np.arange(len(cls)) + 3 * (np.repeat(np.arange(texts), sizes + 1) + 1)
    c = np.full(len(cls) + 3 * texts, CLASSES, np.uint64)
    k = np.zeros(len(cls) + 3 * texts, np.uint64)
    c[at], k[at] = cls.astype(np.uint64), key.view(np.uint64)
    one, two, three = c[at - 1], c[at - 2], c[at - 3]
    h = np.stack([k[at - 1] + _U(1), (one * _U(64) + two) * _U(4) + _U(2), (two * _U(64) + three) * _U(4) + _U(3), k[at - 2] + _U(4)])
    h = (h ^ (h >> _U(29))) * _U(0x9E3779B97F4A7C15)
    return (h >> _U(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)


def logits(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = weights[f[0]]
    for row in f[1:]:
        z += weights[row]
    z += bias
    return np.minimum(z, 60, out=z)


def log_p(weights: np.ndarray, bias: np.ndarray, f: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log probability of class y for each column of features, in batches."""
    out = np.empty(len(y))
    for i in range(0, len(y), BATCH):
        z = logits(weights, bias, f[:, i:i + BATCH])
        own = z[np.arange(len(z)), y[i:i + BATCH]]
        out[i:i + BATCH] = own - np.log(np.exp(z).sum(axis=1))
    return out


class Trainer:
    """Gradient steps from given weights, uses of the buckets, bias and number of steps."""

    def __init__(self, w=None, use=None, bias=None, steps: float = 0.0):
        self.w = np.zeros((1 << LEAST_BITS, CLASSES), np.float32) if w is None else w.copy()
        self.use = np.zeros(len(self.w), np.float32) if use is None else use.copy()
        self.bias = np.zeros(CLASSES, np.float32) if bias is None else bias.copy()
        self.steps = steps

    def step(self, f: np.ndarray, y: np.ndarray) -> None:
        g = logits(self.w, self.bias, f)
        np.exp(g, out=g)
        g /= g.sum(axis=1, keepdims=True)
        g[np.arange(len(y)), y] -= 1
        self.steps += 1
        self.bias -= RATE / self.steps ** 0.5 * g.mean(axis=0)
        for i in range(len(f)):
            order = np.argsort(f[i], kind="stable")
            b = f[i][order]
            first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            at = b[first]
            n = np.diff(np.append(first, len(b))).astype(np.float32)
            self.use[at] += n
            self.w[at] -= (RATE / np.sqrt(self.use[at] * n))[:, None] * np.add.reduceat(g[order], first, axis=0)


_READERS: dict = {}


def _reader(bc) -> Reader:
    claim("maxent", _READERS.clear)
    counts = bc.value
    if _READERS.get("counts") is not counts:
        _READERS.clear()
        _READERS.update(counts=counts, reader=Reader(counts))
    return _READERS["reader"]


def bits_of(tokens: int) -> int:
    """Bits of a bucket number: a bit more for each doubling of the corpus beyond TOKENS_PER_TABLE."""
    return min(MAX_BITS, LEAST_BITS + max(0, (-(-max(tokens, 1) // TOKENS_PER_TABLE) - 1).bit_length()))


def parts_of(tokens: int) -> int:
    """Parts of the corpus that are trained side by side; depends on the corpus alone."""
    return max(1, -(-tokens // TOKENS_PER_PART))


def train(rows: DataFrame, bc, tokens: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after ROUNDS rounds over ``rows`` (doc_id, text).  A round takes a share of the texts by hash;
    each of its parts, also by hash, makes its steps from the last average on its texts in hash order."""
    spark = rows.sparkSession
    parts, bits = parts_of(tokens), bits_of(tokens)
    groups, size = max(1, int(parts ** 0.5)), (1 << bits) // BLOCKS
    dealt = rows.select("text", F.xxhash64("doc_id", "text", F.lit(7)).alias("h"))
    dealt = dealt.select("text", "h", F.pmod("h", F.lit(ROUNDS)).cast("int").alias("round"),
                         F.pmod(F.shiftright("h", 8), F.lit(parts)).cast("int").alias("part"))
    schema = "block int, grp int, part int, w binary, use binary"
    arrow = pa.schema([("block", pa.int32()), ("grp", pa.int32()), ("part", pa.int32()), ("w", pa.binary()), ("use", pa.binary())])
    model = np.zeros((1 << bits, CLASSES), np.float32), np.zeros(1 << bits, np.float32), np.zeros(CLASSES, np.float32), 0.0

    def one_round(texts: DataFrame, start) -> DataFrame:
        def trained(part: int, t: Trainer):
            """The part's weights times what it used of them in this round, in blocks."""
            new = t.use - start.value[1]
            w = t.w * new[:, None]
            rows_ = [(i, part % groups, part, w[i * size:(i + 1) * size].tobytes(), new[i * size:(i + 1) * size].tobytes()) for i in range(BLOCKS)]
            steps = np.float32(t.steps - start.value[3])
            rows_.append((BLOCKS, part % groups, part, (t.bias * steps).astype(np.float32).tobytes(), steps.tobytes()))
            for row in rows_:
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow)], schema=arrow)

        def run(batches):
            t, now, reader = None, None, _reader(bc)
            for b in batches:
                own, texts_ = b.column(1).to_numpy(), b.column(0).to_pylist()
                cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
                for lo, hi in zip(cuts, cuts[1:]):
                    if hi > lo and own[lo] != now:
                        if t is not None:
                            yield from trained(now, t)
                        t, now = Trainer(*start.value), int(own[lo])
                    for first, last in pieces(texts_[lo:hi]):
                        _, sizes, cls, key = reader.read(texts_[lo + first:lo + last])
                        f = features(sizes, cls, key, bits)
                        for i in range(0, len(cls), BATCH):
                            t.step(f[:, i:i + BATCH], cls[i:i + BATCH])
            if t is not None:
                yield from trained(now, t)

        def merged(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("part")  # sums of floats in one order
            w, use = (sum(np.frombuffer(x, np.float32) for x in pdf[c]) for c in ("w", "use"))
            return pd.DataFrame({"block": [pdf["block"].iloc[0]], "grp": [0], "part": [pdf["grp"].iloc[0]], "w": [w.tobytes()], "use": [use.tobytes()]})

        texts = texts.repartition(parts, "part").sortWithinPartitions("part", "h").select("text", "part")
        out = texts.mapInArrow(run, schema).groupBy("block", "grp").applyInPandas(merged, schema)
        return out.groupBy("block").applyInPandas(merged, schema)

    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)
        found = scratch.write(one_round(dealt.filter(F.col("round") == r), sent), f"weights-{r}")
        w, use, bias, steps = (x.copy() if isinstance(x, np.ndarray) else x for x in model)
        for row in found.toLocalIterator():  # BLOCKS + 1 rows of fixed size
            got, new = np.frombuffer(row.w, np.float32), np.frombuffer(row.use, np.float32)
            if row.block == BLOCKS:
                bias, steps = (got / new[0], steps + float(new[0]) / parts) if new[0] else (bias, steps)
                continue
            at = slice(row.block * size, (row.block + 1) * size)
            seen = new > 0
            w[at][seen] = got.reshape(size, CLASSES)[seen] / new[seen, None]
            use[at] += new / parts  # a part's share, so that the steps of the next round go on from it
        model = w, use, bias, steps
        sent.unpersist()
        scratch.drop(f"weights-{r}")
    return model[0], model[2]


# ---------------------------------------------------------------- scoring

PART = "row_id long, doc_id {id}, held_out boolean, n_tokens long, n_head long, base double, score double, tail_keys array<long>, tail_times array<long>"


def partial_scores(rows: DataFrame, bc, model) -> DataFrame:
    """Sums over the head words of each row of (doc_id, held_out, text), and its tail words."""
    longs = pa.list_(pa.int64())

    def run(batches):
        reader, (weights, bias) = _reader(bc), model.value
        bits = len(weights).bit_length() - 1
        counts, row = reader.counts, TaskContext.get().partitionId() << 33
        end = float(np.log10(counts.n_texts + 0.5))
        for b in batches:
            texts = b.column(2).to_pylist()
            for first, last in pieces(texts):
                num, sizes, cls, key = reader.read(texts[first:last])
                starts = np.cumsum(sizes + 1) - (sizes + 1)
                by_text = lambda x: np.add.reduceat(x, starts)
                p = log_p(weights, bias, features(sizes, cls, key, bits), cls) / np.log(10.0) - counts.log_room[cls]
                word = cls != END
                tail, logs = np.zeros(len(cls), dtype=bool), np.full(len(cls), end)
                tail[word], logs[word] = reader.tail[num], reader.logs[num]
                n_tail, head = by_text(tail.astype(np.int64)), by_text(logs)
                where = np.split(key[tail], np.cumsum(n_tail)[:-1])
                rare = [np.unique(x, return_counts=True) for x in where]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(sizes))), b.column(0).slice(first, last - first), b.column(1).slice(first, last - first),
                     pa.array(sizes + 1), pa.array(sizes - n_tail + min(1, counts.n_texts)), pa.array(head), pa.array(by_text(p) + head),
                     pa.array([x[0] for x in rare], longs), pa.array([x[1] for x in rare], longs)],
                    ["row_id", "doc_id", "held_out", "n_tokens", "n_head", "base", "score", "tail_keys", "tail_times"])
                row += len(sizes)

    return rows.mapInArrow(run, PART.format(id=rows.schema["doc_id"].dataType.simpleString()))


def score(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row; learns from
    the rows where the column ``held_out`` is false."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "maxent")
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    learnt = rows.filter("NOT held_out").select("doc_id", "text")
    counts, count_table = counts_of(learnt.select("text"), scratch)
    bc = spark.sparkContext.broadcast(counts)
    model = spark.sparkContext.broadcast(train(learnt, bc, counts.total, scratch))
    part = scratch.write(partial_scores(rows, bc, model), "part")
    tail = part.select("row_id", F.explode(F.arrays_zip("tail_keys", "tail_times")).alias("t")).select(
        "row_id", F.col("t.tail_keys").alias("key"), F.col("t.tail_times").alias("times"))
    rare = count_table.select("key", "n")
    sums = (tail.join(rare, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            .groupBy("row_id").agg(F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("logs"),
                                   F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known")))
    room = float(np.log10(counts.total + 0.5 * (counts.distinct + 1)))
    logs = F.coalesce("logs", F.lit(0.0))
    return part.drop("tail_keys", "tail_times").join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(room)).alias("base_score"), (F.col("score") + logs).alias("score"))


def op7(spark, sf_dir) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fold_of("doc_id", 5) == 1)
