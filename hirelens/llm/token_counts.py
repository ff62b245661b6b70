"""Operator 3, token counts: additive totals maintained by signed deltas.

Totals of documents and tokens by source, language and tokenizer version are kept in a folder of
numbered states, each a table of totals and of the batch ids in it.  A batch of changes becomes
one signed delta per key:

* ``insert`` adds a document and its tokens, ``delete`` takes both away,
* ``revise`` adds the difference of the new and the old count and leaves the documents.

``commit`` adds the delta to the latest state and publishes the next one with one rename.  A batch
whose id is in the state is skipped, so a batch that is sent again, or tried again after a failure
at any point, counts once.  A commit reads the state and the batch, never the corpus.

The delta is a sum per key, combined before the shuffle: a source that holds a third of all rows
is one row per task.

Defined results: a null text has no tokens; null sources and languages are keys of their own; a
null count adds nothing; keys whose documents and tokens are both 0 are left out of the totals;
repeated rows count as often as they come; an empty batch only records its id; other columns are
ignored.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, ready, table

KEYS = ["source", "lang", "tokenizer"]
#: Tokenizer versions that Spark counts itself: words between ASCII white space; and runs of
#: letters, digits and underscores, with each other visible character for itself.
PATTERNS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"[\p{L}\p{N}_]+|[^\x20\x09-\x0D\p{L}\p{N}_]"}


def count_tokens(text: Column, tokenizer: str, model_path: str | None = None) -> Column:
    """Tokens of a text by one of PATTERNS, or by the SentencePiece model at ``model_path``."""
    if model_path is None:
        return F.coalesce(F.regexp_count(text, F.lit(PATTERNS[tokenizer])), F.lit(0)).cast("long")
    with open(model_path, "rb") as f:
        proto = f.read()

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        import sentencepiece

        if proto not in _MODELS:
            _MODELS[proto] = sentencepiece.SentencePieceProcessor(model_proto=proto)
        return pa.array([len(x) for x in _MODELS[proto].encode([t or "" for t in texts.to_pylist()], num_threads=1)])

    return count(text)


_MODELS: dict = {}


def delta(changes: DataFrame) -> DataFrame:
    """Signed sums per key of (source, lang, tokenizer, op, n_tokens, old_tokens)."""
    n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    tokens = F.when(F.col("op") == "revise", n - old).otherwise(sign * n)
    return changes.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens"))


class Rollup:
    """The states below ``root``, a folder that the whole cluster shares."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _version(self) -> int:
        """The latest published state; 0: none."""
        at = self._path(f"{self.root}/states")
        if not self._fs.exists(at):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return max([int(x) for x in names if x.isdigit()], default=0)

    def _read(self, version: int, what: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/states/{version}/{what}")

    def committed(self, batch_id: str) -> bool:
        v = self._version()
        return bool(v) and bool(self._read(v, "batches").filter(F.col("batch_id") == batch_id).limit(1).count())

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if it is in the totals already."""
        if self.committed(batch_id):
            return False
        change = delta(changes)
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        change.write.parquet(f"{draft}/delta")
        change = self.spark.read.parquet(f"{draft}/delta")
        while True:
            v = self._version()
            ids = self.spark.createDataFrame([(batch_id,)], "batch_id string")
            totals = change
            if v:
                if self.committed(batch_id):
                    return False
                ids = ids.unionByName(self._read(v, "batches"))
                totals = change.unionByName(self._read(v, "totals"))
            totals = totals.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            state = f"{draft}/{v + 1}"
            totals.write.parquet(f"{state}/totals")
            ids.coalesce(1).write.parquet(f"{state}/batches")
            self._fs.mkdirs(self._path(f"{self.root}/states"))
            target = self._path(f"{self.root}/states/{v + 1}")
            # one writer wins a version; another one starts anew from the state it lost to
            if not self._fs.exists(target) and self._fs.rename(self._path(state), target):
                return True

    def totals(self) -> DataFrame:
        v = self._version()
        if not v:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
        return self._read(v, "totals").filter("n_docs != 0 OR n_tokens != 0")


def without_mail_lines(text: Column) -> Column:
    """What the third batch of the query revises: lines with an at sign are taken out."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.contains("@")), "\n")


def op3(spark, sf_dir) -> DataFrame:
    """All documents are inserted (and the batch sent twice), later copies of a text deleted, the
    others revised to the text without mail lines, and counted by a second tokenizer version."""
    ready(spark)
    scratch = Scratch(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    counted = scratch.write(docs.select(
        "doc_id", "source", "lang", F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit("")).cast("binary")).alias("text_key"),
        count_tokens(text, "words-1").alias("n1"), count_tokens(text, "words-2").alias("n2"),
        count_tokens(without_mail_lines(text), "words-1").alias("revised")), "counted")
    # joined by text and id, so that a text of many copies is not one task's
    first = counted.groupBy(F.col("text_key").alias("k")).agg(F.min("doc_id").alias("first_id")).withColumn("first", F.lit(True))
    flagged = (counted.join(first, (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
               .withColumn("copy", F.col("first").isNull()))

    def batch(df: DataFrame, op: str, tokenizer: str, n: str, old: Column | None = None) -> DataFrame:
        return df.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(op).alias("op"), F.col(n).alias("n_tokens"),
                         (F.lit(None).cast("long") if old is None else old).alias("old_tokens"))

    sums = Rollup(spark, f"{scratch.root}/rollup")
    load = batch(counted, "insert", "words-1", "n1")
    sums.commit("load", load)
    sums.commit("load", load)
    sums.commit("copies", batch(flagged.filter("copy"), "delete", "words-1", "n1"))
    stay = flagged.filter("NOT copy")
    sums.commit("revision", batch(stay, "revise", "words-1", "revised", F.col("n1"))
                .unionByName(batch(stay, "insert", "words-2", "n2")))
    return sums.totals()


ORACLE = r"""
WITH d AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n1,
    len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_]+|[^\x20\x09-\x0D\p{L}\p{N}_]')) AS n2,
    len(regexp_extract_all(regexp_replace(coalesce(text, ''), '[^\n]*@[^\n]*\n?', '', 'g'), '[^\x20\x09-\x0D]+')) AS r1 FROM documents),
f AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text),
k AS (SELECT d.* FROM d JOIN f ON d.text IS NOT DISTINCT FROM f.text AND d.doc_id IS NOT DISTINCT FROM f.first_id)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs, CAST(sum(r1) AS BIGINT) AS n_tokens FROM k GROUP BY source, lang
UNION ALL
SELECT source, lang, 'words-2', count(*), CAST(sum(n2) AS BIGINT) FROM k GROUP BY source, lang
"""
