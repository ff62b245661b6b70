"""Validation (F1-F7) and batch metrics.

Rules run as one projection (no shuffle) and are pushed below dedup and cleaning,
the order the reference uses: filter -> dedup on raw text -> normalise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import config
from hirelens.functions.text import col_, contains_any, py_strip


def reject_reason(title="title", source="source", description="description",
                  record_ok: Column | None = None,
                  valid_sources=tuple(config.VALID_SOURCES),
                  spam_phrases=tuple(config.SPAM_PHRASES),
                  min_title_chars: int = config.MIN_TITLE_CHARS) -> Column:
    """the first failing rule, or null for a valid row.

    F1 ``not_object``: the raw record is not a non-empty object (JSON input only);
    F2 ``short_title``: stripped title shorter than ``min_title_chars`` (null title fails);
    F3 ``bad_source``: a present source whose lower case is not allowed (absent passes);
    F4 ``spam``: a literal spam phrase in the lower-cased title or description.
    """
    t, s, d = col_(title), col_(source), col_(description)
    t_low = F.lower(F.coalesce(t, F.lit("")))
    d_low = F.lower(F.coalesce(d, F.lit("")))
    phrases = [p.lower() for p in spam_phrases]
    rules = []
    if record_ok is not None:
        rules.append((~F.coalesce(record_ok, F.lit(False)), "not_object"))
    rules += [
        (t.isNull() | (F.length(py_strip(t)) < min_title_chars), "short_title"),
        (s.isNotNull() & ~F.lower(s).isin(list(valid_sources)), "bad_source"),
        (contains_any(t_low, phrases) | contains_any(d_low, phrases), "spam"),
    ]
    expr = None
    for cond, name in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def with_reject_reason(df: DataFrame, **kw) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(**kw))


def valid(df: DataFrame, **kw) -> DataFrame:
    """Accepted rows only (F5 as a filter)."""
    return df.filter(reject_reason(**kw).isNull())


def split_valid(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects-with-reason); both lazy views of one projection."""
    tagged = with_reject_reason(df, **kw)
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"), \
        tagged.filter(F.col("reject_reason").isNotNull())


def score_threshold(df: DataFrame, min_score: float = 0.5, score_col: str = "match_score") -> DataFrame:
    """``match_score >= min_score`` with a missing score counting as 0."""
    return df.filter(F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)) >= F.lit(float(min_score)))


def batch_metrics(tagged: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """Rows per outcome (``accepted`` or a reject reason); map-side partial counts."""
    return (tagged.groupBy(F.coalesce(F.col(reason_col), F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
