"""Report aggregates (A1-A5, A7), top skills (T5) and display rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions import fmt
from hirelens.functions import salary as sal
from hirelens.operators.rank import rank_postings, top_k


def summary(df: DataFrame, score_col: str = "match_score") -> DataFrame:
    """A1: row count and mean score (nulls skipped; 0 when the column is absent)."""
    avg = F.avg(F.col(score_col).cast("double")) if score_col in df.columns else F.lit(0.0)
    return df.agg(F.count(F.lit(1)).alias("n_jobs"), F.coalesce(avg, F.lit(0.0)).alias("avg_match_score"))


def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    """A2 + A3 + X6: jobs per source (nulls excluded), share in percent, display name."""
    c = df.filter(F.col(source).isNotNull()).groupBy(source).agg(F.count(F.lit(1)).alias("n_jobs"))
    # The window runs over the aggregated table: one row per distinct source.
    return c.select(F.col(source).alias("source"), fmt.source_title(F.col(source)).alias("source_name"), "n_jobs",
                    (F.col("n_jobs") * 100.0 / F.sum("n_jobs").over(Window.partitionBy())).alias("share_pct"))


def score_histogram(df: DataFrame, score_col: str = "match_score", bins: int = 10) -> DataFrame:
    """A4: counts of score*100 in ``bins`` equal bins over the observed min..max.

    Edges are ``lo + i*step`` as a linspace builds them; a value belongs to bin i when
    edge_i <= x < edge_(i+1); the last bin is closed; min = max widens to +-0.5.
    The scores are computed once: distinct values with their counts, combined before the
    shuffle, carry both the range and the bins, and nothing is fetched to the driver.
    """
    xs = (df.select((F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)) * 100).alias("x"))
          .groupBy("x").agg(F.count(F.lit(1)).alias("n")))
    # the count is part of it, so that all uses of ``xs`` have the same exchange and the scores are computed once
    spread = xs.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("rows"))
    same = F.col("lo") == F.col("hi")
    spread = spread.filter("rows > 0").select(F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                                                    F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    spread = spread.withColumn("step", (F.col("hi") - F.col("lo")) / bins).withColumn("one", F.lit(1))
    j = xs.withColumn("one", F.lit(1)).join(F.broadcast(spread), "one")  # the range: exactly one row
    lo, step, x = F.col("lo"), F.col("step"), F.col("x")
    g = F.least(F.greatest(F.floor((x - lo) / step), F.lit(0)), F.lit(bins - 1)).cast("int")
    b = (F.when(x < lo + g * step, g - 1)
         .when((g < bins - 1) & (x >= lo + (g + 1) * step), g + 1)
         .otherwise(g))
    counts = j.select(b.alias("bin"), "n").groupBy("bin").agg(F.sum("n").alias("n_jobs"))
    edges = (spread.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
             .select("bin", (lo + F.col("bin") * step).alias("bin_lo"),
                     F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(lo + (F.col("bin") + 1) * step).alias("bin_hi")))
    return edges.join(counts, "bin", "left").select("bin", "bin_lo", "bin_hi",
                                                    F.coalesce("n_jobs", F.lit(0)).cast("bigint").alias("n_jobs"))


def skill_items(df: DataFrame, skills: str = "skills", as_text: bool = False) -> DataFrame:
    """Exploded skills; a comma string is split and trimmed (A5's input rule)."""
    arr = F.transform(F.split(F.col(skills), ","), lambda s: F.trim(s)) if as_text else F.col(skills)
    return df.select(F.explode(arr).alias("skill"))


def skill_frequency(df: DataFrame, skills: str = "skills", as_text: bool = False) -> DataFrame:
    """A5: occurrences of each skill over all postings (partial counts before the shuffle)."""
    return skill_items(df, skills, as_text).groupBy("skill").agg(F.count(F.lit(1)).alias("n_jobs"))


def top_skills(df: DataFrame, n: int = 15, skills: str = "skills", as_text: bool = False) -> DataFrame:
    """T5: the ``n`` most frequent skills (ties by name)."""
    return skill_frequency(df, skills, as_text).orderBy(F.desc("n_jobs"), F.asc("skill")).limit(n)


def distinct_skills(df: DataFrame, skills: str = "skills") -> DataFrame:
    """The batch's distinct skill names (the dimension feed)."""
    return skill_items(df, skills).filter(F.col("skill").isNotNull()).distinct()


def display_rows(df: DataFrame, k: int | None = 20, location_default: str = "Not specified") -> DataFrame:
    """The top-k postings as display rows (report cards; mail uses k = max_jobs);
    ``None``: all, as a distributed sort."""
    t = rank_postings(df) if k is None else top_k(df, k)
    s = F.col("salary")
    return t.select(
        "input_seq",
        F.coalesce(F.col("title"), F.lit("Untitled Job")).alias("title"),
        F.round(F.coalesce(F.col("match_score"), F.lit(0.0)) * 100, 6).alias("match_pct"),
        fmt.score_percent("match_score").alias("match_text"),
        F.coalesce(F.col("company"), F.lit("Unknown")).alias("company"),
        fmt.location_display(F.col("remote"), F.col("location"), location_default).alias("location"),
        F.coalesce(F.col("source"), F.lit("Unknown")).alias("source"),
        sal.salary_display(s["min"], s["max"], sal.to_iso(s["currency"])).alias("salary_text"),
        fmt.skills_preview(F.col("skills")).alias("skills_preview"),
        F.coalesce(F.col("url"), F.lit("#")).alias("url"),
    )
