"""Operator 1, toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text (never its id, language, source or labels): densities of lexicon words
(a public seed list, words and word beginnings mined from labelled texts, each also after undoing
obfuscation such as ``1d10t`` or ``i.d.i.o.t``), how many of them stand within five words of a
second-person word, and rates of capitals, shouted words, punctuation, symbols, digits and
obfuscated words.

Fit, on labelled rows outside the held-out fold (crc32(doc_id) mod 3 = 1): a hash sample of about
``MAX_LABELLED`` rows, split by hash into one half for the lexicon, a third for the trees and a
sixth for the calibration, so that no part learns from what another one was fitted on.  The
lexicon has at most ``MAX_LEXICON`` entries and is broadcast.  Scoring is one pass without a
shuffle over all rows.

Defined results: a null text scores as the empty one; repeated labels of a doc_id count once, the
larger one; labels without doc_id or value are left out; rows without doc_id are scored and not
held out; if the labelled rows have one class only, all scores are its label, and 0 without any;
repeated rows get equal scores; empty tables give no rows; :func:`with_score` keeps all columns.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, claim, fold_of, ready, table

MAX_LABELLED = 20_000
MAX_LEXICON = 5_000
PREFIXES = (4, 5, 6)
NEAR = 5
THRESHOLD = 0.7
MAX_KNOWN = 400_000

SEED = set("""
idiot idiots moron morons stupid dumb scum trash loser losers clown clowns pathetic worthless
disgusting imbecile jerk bastard bitch asshole fool fools ugly filth pig vermin freak hate kill
dumm idioten arschloch abschaum widerlich wertlos hässlich trottel versager dreck schwein
idiota estúpido estúpida imbécil basura asqueroso patético inútil cabrón cerdo
stupide imbécile connard salaud ordure minable débile dégoûtant crétin
""".split())
SECOND = set("""
you your yours yourself yourselves u ur du dich dir dein deine deinen euch ihr eure tu te toi ton ta tes vous
votre vos tú ti tus usted ustedes vosotros
""".split())
LEET = str.maketrans("013457@$!|€", "oieastasiie")

IS_SEED, IS_WORD, IS_PREFIX, IS_SECOND, IS_HIDDEN, IS_MIXED = 1, 2, 4, 8, 16, 32
HIT = IS_SEED | IS_WORD | IS_PREFIX
FEATURES = ["log_words", "seed", "mined", "beginnings", "hits", "distinct", "second", "near_share", "near", "upper",
            "shouted", "exclaim", "question", "symbols", "other_punct", "digits", "hidden", "mixed"]

_CLASS = np.zeros(256, dtype=np.uint8)
for _c, _chars in enumerate(["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!", "?", "*#$%&@~^<>|+=", ".,;:-_()[]{}'\"/\\`", "0123456789"], 1):
    _CLASS[list(_chars.encode())] = _c
_shouted = re.compile(r"\b[A-Z]{3,}\b").findall
_letters = re.compile(r"[^\W\d_]+").findall
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&@~^+=-_/\\`"


class Lexicon:
    """Marks of a token, remembered for a bounded number of tokens."""

    def __init__(self, entries: list[str]):
        self.words = {e[1:] for e in entries if e[0] == "="}
        self.starts = {e[1:] for e in entries if e[0] == "^"}
        self.known: dict[str, int] = {}

    def plain(self, w: str) -> int:
        return ((IS_SEED if w in SEED else 0) | (IS_WORD if w in self.words else 0) | (IS_SECOND if w in SECOND else 0)
                | (IS_PREFIX if any(w[:n] in self.starts for n in PREFIXES if len(w) >= n) else 0))

    def mark(self, token: str) -> int:
        w = token.strip(_EDGE)
        if w.isalpha():
            m = self.plain(w)
        else:
            parts = _letters(w)
            m = 0
            for p in parts:
                m |= self.plain(p)
            if parts:
                m |= IS_MIXED
                bare = "".join(c for c in w.translate(LEET) if c.isalpha())
                hidden = self.plain(bare) & HIT if len(bare) >= 4 else 0
                if hidden and not m & HIT:
                    m |= hidden | IS_HIDDEN
        if len(self.known) >= MAX_KNOWN:
            self.known.clear()
        self.known[token] = m
        return m

    def features(self, text: str) -> list[float]:
        tokens = text.lower().split()
        get, mark = self.known.get, self.mark
        marks = np.array([m if (m := get(t)) is not None else mark(t) for t in tokens], dtype=np.int64)
        n = max(1, len(tokens))
        hits = np.flatnonzero(marks & HIT)
        second = np.flatnonzero(marks & IS_SECOND)
        near = 0
        if len(hits) and len(second):
            at = np.searchsorted(second, hits)
            left = np.abs(hits - second[np.maximum(at - 1, 0)])
            right = np.abs(second[np.minimum(at, len(second) - 1)] - hits)
            near = int((np.minimum(left, right) <= NEAR).sum())
        raw = text.encode()
        c = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=7) / max(1, len(raw))
        count = lambda bit: float(np.count_nonzero(marks & bit)) / n
        return [float(np.log1p(len(tokens))), count(IS_SEED), count(IS_WORD), count(IS_PREFIX), float(np.log1p(len(hits))),
                float(np.log1p(len({tokens[i] for i in hits}))), len(second) / n, near / max(1, len(hits)), near / n,
                c[1], len(_shouted(text)) / n, c[2], c[3], c[4], c[5], c[6], count(IS_HIDDEN), count(IS_MIXED)]


def entries_of(text: str) -> set[str]:
    """Lexicon candidates of a text: its words and their beginnings."""
    words = {w for t in set(text.lower().split()) for w in _letters(t)}
    return {"=" + w for w in words} | {"^" + w[:n] for w in words for n in PREFIXES if len(w) >= n}


def mine_lexicon(rows: DataFrame) -> list[str]:
    """Entries of (text, toxic) whose documents are toxic nearly always."""
    def count(batches):
        claim("toxicity", _forget)
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[toxic].update(entries_of(text))
        for toxic, c in seen.items():
            keys = list(c)
            for i in range(0, len(keys), 50_000):
                k = keys[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.string()), pa.array([toxic] * len(k), pa.int32()), pa.array([c[x] for x in k], pa.int64())],
                    ["entry", "toxic", "n"])

    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = 5 if totals.get(1, 0) >= 100 else 3
    both = (rows.select(F.coalesce("text", F.lit("")).alias("text"), "toxic").mapInArrow(count, "entry string, toxic int, n long")
            .groupBy("entry").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                                  F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good")))
    t, c = totals.get(1, 0) + 1.0, totals.get(0, 0) + 1.0
    both = both.filter((F.col("bad") >= least) & (F.col("bad") >= 0.8 * (F.col("bad") + F.col("good")))
                       & ((F.col("bad") + 0.5) / t >= 8 * (F.col("good") + 0.5) / c))
    return [r.entry for r in both.orderBy(F.desc("bad"), "entry").limit(MAX_LEXICON).collect()]


_LOADED: list = [None, None]


def _forget() -> None:
    _LOADED[:] = [None, None]


def _loaded(entries: list[str]) -> Lexicon:
    """The worker's lexicon, kept between tasks with the tokens it knows."""
    claim("toxicity", _forget)
    if _LOADED[0] is not entries:
        _LOADED[:] = [entries, Lexicon(entries)]
    return _LOADED[1]


def features(text: Column, lexicon) -> Column:
    """array<double> of FEATURES; ``lexicon`` is a broadcast list of entries."""
    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        lex = _loaded(lexicon.value)
        return pa.array([lex.features(t or "") for t in texts.to_pylist()], pa.list_(pa.float64()))

    return of(text)


class Model:
    """A fitted lexicon, trees and calibration; ``constant`` if there was nothing to learn."""

    def __init__(self, spark, entries=(), trees=None, calibration=None, constant: float = 0.0):
        self.entries, self.trees, self.calibration, self.constant = list(entries), trees, calibration, constant
        self.lexicon = spark.sparkContext.broadcast(self.entries)

    def raw(self, df: DataFrame, text: Column) -> DataFrame:
        """``df`` with the trees' probability in ``__tox_raw``."""
        d = df.withColumn("__tox_features", array_to_vector(features(text, self.lexicon)))
        d = self.trees.transform(d)
        return d.withColumn("__tox_raw", vector_to_array("__tox_p")[1]).drop("__tox_features", "__tox_margin", "__tox_p", "__tox_class")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    lab = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
           .filter(fold_of("doc_id", 3) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = lab.count()
    share = min(1.0, max_labelled / max(1, n))
    lab = lab.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(6))
    rows = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id").select("text", "toxic", part.alias("part"))
    rows = scratch.write(rows, "labelled")
    counts = {(r.toxic, r.part): r.n for r in rows.groupBy("toxic", "part").agg(F.count("*").alias("n")).collect()}
    have = lambda toxic, parts: sum(counts.get((toxic, p), 0) for p in parts)
    if not have(1, range(6)) or not have(0, range(6)):
        return Model(spark, constant=1.0 if have(1, range(6)) else 0.0)
    entries = mine_lexicon(rows.filter("part < 3"))
    tree_parts, fit_parts = [3, 4], [5]
    if not have(1, tree_parts) or not have(0, tree_parts):
        tree_parts = list(range(6))
    if not have(1, fit_parts) or not have(0, fit_parts):
        fit_parts = list(range(3, 6)) if have(1, range(3, 6)) and have(0, range(3, 6)) else list(range(6))
    model = Model(spark, entries)
    known = scratch.write(rows.select("part", F.col("toxic").cast("double").alias("label"),
                                      features(F.col("text"), model.lexicon).alias("features")).coalesce(4), "features")
    vectors = known.select("part", "label", array_to_vector("features").alias("__tox_features"))
    gbt = GBTClassifier(featuresCol="__tox_features", labelCol="label", predictionCol="__tox_class", maxIter=20, maxDepth=3,
                        stepSize=0.3, minInstancesPerNode=3, seed=5).setRawPredictionCol("__tox_margin").setProbabilityCol("__tox_p")
    model.trees = gbt.fit(vectors.filter(F.col("part").isin(tree_parts)))
    raw = model.trees.transform(vectors.filter(F.col("part").isin(fit_parts))).withColumn("__tox_raw", vector_to_array("__tox_p")[1])
    model.calibration = IsotonicRegression(featuresCol="__tox_raw", labelCol="label", predictionCol="__tox_score").fit(raw.select("__tox_raw", "label"))
    scratch.drop("labelled", "features")
    return model


def with_score(docs: DataFrame, model: Model, out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col``, the probability of label 1 (0 to 1)."""
    if model.trees is None:
        return docs.withColumn(out_col, F.lit(model.constant))
    d = model.calibration.transform(model.raw(docs, F.col("text")))
    return d.withColumn("__tox_score", F.least(F.greatest("__tox_score", F.lit(0.0)), F.lit(1.0))).drop("__tox_raw", out_col).withColumnRenamed("__tox_score", out_col)


def op1(spark, sf_dir) -> DataFrame:
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
