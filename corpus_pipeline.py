"""The corpus pipeline: five stages, each one operator of hirelens.llm over all rows it is given.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs.  All but the last return the columns of ``documents``.

Defined results, stage by stage: null texts count as empty for a score, stay null through the line
stage, link with nothing, hold no passage, and are encoded as the empty text (its end id alone); empty and
blank texts likewise.  Rows without doc_id are scored, never held out, and count as one document in the line
stage, later than all others.  Repeated rows get equal decisions; of a group of near copies the row with
the smallest doc_id stays, once.  Very long texts are read whole in every stage.  An empty table gives no rows.  Columns
beside those of ``documents``, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import decontam, lines, minhash, pieces, toxicity
from hirelens.llm.common import Scratch, ready, table


#: Chunks that a worker of the encoding stage remembers, about 25 MB a period.
REMEMBERED = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below the threshold."""
    ready(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, model, "__toxicity")
    return scored.filter(F.col("__toxicity") < toxicity.THRESHOLD).select(*[scored[c] for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; n_chars follows the text.  Lines that a
    document shares with a near copy that keeps them are left to the near-duplicate stage.  DataFrame functions only."""
    ready(spark)
    out = lines.drop_recurring(docs, spare_copies=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ready(spark)
    return minhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    ready(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids (the end id included), and the decoded text's hash."""
    ready(spark)
    path = pieces.default_model()
    d = docs.select(*[c for c in ("doc_id", "source", "lang") if c in docs.columns], F.coalesce("text", F.lit("")).alias("text"))
    # after four stages an executor's heap is at its full size: the workers keep fewer chunks than in a run of their own
    d = pieces.decode(pieces.encode(d, path, remembered=REMEMBERED), path, remembered=REMEMBERED)
    return d.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("text", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: Boosted trees, edit distances and piece merges are beyond SQL; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
