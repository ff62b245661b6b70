"""End-to-end compositions of the operators (the reference's DAG as lazy plans).

collect -> clean (validate, dedup, normalise) -> match (score, rank)
        -> { report (aggregates + top 20), notify (threshold + top N), save (relational model) }

Each stage is a function of DataFrames; callers persist or write where they fan out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hirelens.functions.skills import TECH_SKILLS
from hirelens.operators import dedup, load, normalize, rank, report, scoring, validate


def clean(raw: DataFrame, near_dedup: bool = True, dictionary: list[str] = TECH_SKILLS,
          threshold: float = 0.9, prefer_iso: bool = False) -> tuple[DataFrame, DataFrame]:
    """Validate -> dedup on raw text -> normalise.  Returns (cleaned, rejects).

    ``near_dedup=True`` is the reference rule (greedy similarity, exact copies
    included); ``False`` keeps only the exact-signature dedup (D1).
    """
    kw = {"record_ok": F.col("record_ok")} if "record_ok" in raw.columns else {}
    accepted, rejected = validate.split_valid(raw, **kw)
    kept = dedup.dedup_near(accepted, threshold) if near_dedup else dedup.dedup_exact(accepted)
    ok, bad = normalize.split_normalized(normalize.normalize(kept, dictionary, prefer_iso))
    rejects = rejected.select("input_seq", "reject_reason").unionByName(bad.select("input_seq", "reject_reason"))
    return ok, rejects


def clean_metrics(raw: DataFrame, near_dedup: bool = True, dictionary: list[str] = TECH_SKILLS,
                  threshold: float = 0.9) -> DataFrame:
    """A6 for the whole clean stage: rows in, out and dropped by validation, de-duplication and
    normalisation.  Each count is a partial aggregation; one row each meets in the result."""
    kw = {"record_ok": F.col("record_ok")} if "record_ok" in raw.columns else {}
    accepted = validate.valid(raw, **kw)
    kept = dedup.dedup_near(accepted, threshold) if near_dedup else dedup.dedup_exact(accepted)
    ok, _ = normalize.split_normalized(normalize.normalize(kept, dictionary))
    tables = {"raw": raw, "validate": accepted, "dedup": kept, "normalize": ok}
    counts = None
    for i, (name, df) in enumerate(tables.items()):
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), F.lit(name).alias("stage"), "n")
        counts = c if counts is None else counts.unionByName(c)
    before = counts.select((F.col("i") + 1).alias("i"), F.col("n").alias("n_in"))
    return counts.join(before, "i").select("stage", "n_in", F.col("n").alias("n_out"), (F.col("n_in") - F.col("n")).alias("n_dropped"))


def clean_observed(raw: DataFrame, path: str, near_dedup: bool = False, dictionary: list[str] = TECH_SKILLS,
                   threshold: float = 0.9) -> tuple[DataFrame, DataFrame, list[dict]]:
    """A6 by observation: the clean stage written below ``path``, its counts collected while it is written.

    Returns (cleaned, rejects, steps); a step has stage, n_in, n_out, n_dropped.  ``raw`` is read once: the first
    write takes the accepted rows and the rejects apart, the second goes on from the accepted ones.  Both counts
    are taken in the last stage of their write, whose tasks count once even when they are tried again.
    """
    spark = raw.sparkSession
    kw = {"record_ok": F.col("record_ok")} if "record_ok" in raw.columns else {}
    counted = lambda df, name, **m: (o := Observation(name), df.observe(o, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in m.items()]))
    first, tagged = counted(validate.with_reject_reason(raw, **kw), "validate", ok=F.count(F.when(F.col("reject_reason").isNull(), 1)))
    tagged.withColumn("accepted", F.col("reject_reason").isNull()).write.partitionBy("accepted").parquet(f"{path}/validated")
    both = spark.read.schema(tagged.schema.add("accepted", "boolean")).parquet(f"{path}/validated")
    accepted = both.filter("accepted").drop("accepted", "reject_reason")
    kept = dedup.dedup_near(accepted, threshold) if near_dedup else dedup.dedup_exact(accepted)
    norm = normalize.normalize(kept, dictionary)
    second, norm = counted(norm, "normalize", ok=F.count(F.when(F.col("reject_reason").isNull(), 1)))
    norm.withColumn("accepted", F.col("reject_reason").isNull()).write.partitionBy("accepted").parquet(f"{path}/normalized")
    done = spark.read.schema(norm.schema.add("accepted", "boolean")).parquet(f"{path}/normalized")
    cleaned = done.filter("accepted").drop("accepted", "reject_reason")
    rejects = (both.filter("not accepted").select("input_seq", "reject_reason")
               .unionByName(done.filter("not accepted").select("input_seq", "reject_reason")))
    a, b = first.get, second.get
    sizes = [("validate", a["n"], a["ok"]), ("dedup", a["ok"], b["n"]), ("normalize", b["n"], b["ok"])]
    return cleaned, rejects, [{"stage": s, "n_in": i, "n_out": o, "n_dropped": i - o} for s, i, o in sizes]


def load_observed(rows: DataFrame, path: str, run_date: str, first_id: int = 1, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[dict]]:
    """The load from text rows written below ``path``: (listings, rejects, steps): rows converted, and rows loaded
    (fewer if ``existing`` has some)."""
    spark = rows.sparkSession
    read, written = Observation("convert"), Observation("load")
    text = load.convert_text(rows)
    text = text.observe(read, F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("fault").isNull(), 1)).alias("ok"))
    text.write.parquet(f"{path}/converted")
    ok, bad = load.split_converted(spark.read.schema(text.schema).parquet(f"{path}/converted"))
    listings = load.exact_figures(load.load_listings(ok, run_date, first_id, existing))
    listings.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/listings")
    a, b = read.get, written.get
    steps = [("convert", a["n"], a["ok"]), ("load", a["ok"], b["n"])]
    return (spark.read.schema(listings.schema).parquet(f"{path}/listings"), bad,
            [{"stage": s, "n_in": i, "n_out": o, "n_dropped": i - o} for s, i, o in steps])


def match(cleaned: DataFrame, profile: dict, model: str = "full", **kw) -> DataFrame:
    """Score every posting (unsorted; rank lazily where a consumer needs order)."""
    return scoring.score(cleaned, profile, model, **kw)


def report_tables(scored: DataFrame, top: int = 20) -> dict[str, DataFrame]:
    """A1-A5, T3/X7, T5 -- the numbers behind the HTML report."""
    return {
        "summary": report.summary(scored),
        "sources": report.source_counts(scored),
        "histogram": report.score_histogram(scored),
        "top_skills": report.top_skills(scored),
        "cards": report.display_rows(scored, top),
    }


def notify_rows(scored: DataFrame, min_score: float = 0.5, max_jobs: int = 10,
                already_sent: DataFrame | None = None) -> DataFrame:
    """T4 (+J6): qualifying rows not notified before, best first, as mail rows."""
    q = scored if already_sent is None else load.not_yet_notified(scored, already_sent)
    sent = rank.notification_set(q, min_score, max_jobs)
    return report.display_rows(sent, max_jobs if max_jobs > 0 else None, location_default="")


def save_tables(scored: DataFrame, run_date: str, top: int | None = None, skills_dim: DataFrame | None = None,
                first_id: int = 1) -> dict[str, DataFrame]:
    """Listings, skill dimension, bridge, client details.

    The whole ranked table is loaded; ``top`` loads the first rows only, as the
    reference does when its load step reads the top-50 export (S8).
    """
    exported = scored if top is None else rank.top_k(scored, top)
    listings = load.load_listings(exported, run_date, first_id)
    dim = load.upsert_skills(listings, skills_dim)
    return {
        "job_listings": listings,
        "skills": dim,
        "job_skills": load.build_job_skills(listings, dim),
        "client_details": load.build_client_details(listings),
    }
