"""Scoring of postings against a preference profile.

``score(df, profile, model='full'|'simple')`` appends the six score columns.
Everything is a per-row expression (no shuffle, no join): the profile's term
lists are literals.
"""

from __future__ import annotations

from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import config
from hirelens.functions import salary as sal
from hirelens.functions import skills as sk
from hirelens.functions.text import contains_any, count_contained, match_text, tokens
from hirelens.operators.normalize import once
from hirelens.operators.profile import preference_vector

SCORES = ["match_score", "skill_score", "location_score", "salary_score", "company_score", "description_score"]


def _ratio(hits: Column, n: int) -> Column:
    return hits.cast("double") / F.lit(float(max(1, n)))


# ---------------------------------------------------------------- full model

def text_cosine(df: DataFrame, text: Column, profile: dict, out: str = "text_cosine",
                stop_words=None) -> DataFrame:
    """M2: cosine between the posting's 1-/2-gram counts on the profile vocabulary
    and the profile vector (0 when no term is shared or the profile has no terms)."""
    vec = preference_vector(profile, stop_words)
    if not vec:
        return df.withColumn(out, F.lit(0.0))
    stop = list(config.STOP_WORDS if stop_words is None else stop_words)
    kept = F.filter(tokens(text), lambda t: ~t.isin(stop)) if stop else tokens(text)
    known = {f"_t{i}": t for i, t in enumerate(vec)}
    tmp = once(df, _kept=kept)
    n = F.size("_kept")
    grams = F.col("_kept")
    if any(" " in t for t in vec):
        grams = F.concat(grams, F.zip_with(F.slice("_kept", 1, F.greatest(n - 1, F.lit(0))), F.slice("_kept", 2, F.greatest(n - 1, F.lit(0))),
                                           lambda a, b: F.concat(a, F.lit(" "), b)))
    # the grams that the profile has, in one pass; the counts of each are taken from these few
    tmp = once(tmp, _hits=F.filter(grams, lambda g: g.isin(list(vec))))
    tmp = once(tmp, **{c: (F.size("_hits") - F.size(F.array_remove("_hits", t))).cast("double") for c, t in known.items()})
    dot = reduce(lambda a, b: a + b, [F.col(c) * float(vec[t]) for c, t in known.items()])
    nrm = F.sqrt(reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in known]))
    cos = F.when(nrm > 0, dot / nrm).otherwise(F.lit(0.0))
    return once(tmp, **{out: cos}).drop("_kept", "_hits", *known)


def description_score(clean: Column, cosine: Column, profile: dict) -> Column:
    """M3+M4: (0.6*cos + 0.4*keyword share) * (1 - 0.7*excluded share), clamped to [0, 1]."""
    kws = config.get(profile, "keywords", default=[])
    excl = config.get(profile, "excluded_terms", default=[])
    kw = _ratio(count_contained(clean, kws), len(kws))
    ex = _ratio(count_contained(clean, excl), len(excl))
    s = (cosine * 0.6 + kw * 0.4) * (F.lit(1.0) - ex * 0.7)
    return F.greatest(F.lit(0.0), F.least(s, F.lit(1.0)))


def skill_score(skills: Column, profile: dict, exact: bool = False) -> Column:
    """M5 (substring) / M10 (exact): 0.7*must share + 0.3*nice share; empty list -> 1.0."""
    must = config.get(profile, "skills", "must_have", default=[])
    nice = config.get(profile, "skills", "nice_to_have", default=[])
    count = sk.count_exact_hits if exact else sk.count_substring_hits
    m = F.lit(1.0) if not must else count(skills, must).cast("double") / F.lit(float(len(must)))
    n = F.lit(1.0) if not nice else count(skills, nice).cast("double") / F.lit(float(len(nice)))
    return m * 0.7 + n * 0.3


def location_score(location: Column, remote: Column, profile: dict, use_exclusions: bool = True) -> Column:
    """M6 (full) / M11 (simple, no excluded regions): remote wanted > excluded > country > remote > 0.2."""
    pref_remote = bool(config.get(profile, "locations", "remote", default=False))
    countries = [c.lower() for c in config.get(profile, "locations", "countries", default=[])]
    regions = [r.lower() for r in config.get(profile, "locations", "exclude_regions", default=[])] if use_exclusions else []
    is_remote = F.coalesce(remote.cast("boolean"), F.lit(False))
    loc = F.lower(F.coalesce(location, F.lit("")))
    return (F.when(is_remote & F.lit(pref_remote), F.lit(1.0))
            .when(contains_any(loc, regions), F.lit(0.0))
            .when(contains_any(loc, countries), F.lit(0.8))
            .when(is_remote & F.lit(not pref_remote), F.lit(0.5))
            .otherwise(F.lit(0.2)))


def company_score(company: Column, profile: dict, type_terms: dict | None = None) -> Column:
    """M8: share of wanted company types recognised by name heuristics; 0.7 without wanted types."""
    types = config.get(profile, "company_types", default=[])
    if not types:
        return F.lit(0.7)
    terms = type_terms or config.COMPANY_TYPE_TERMS
    low = F.lower(F.coalesce(company, F.lit("")))
    matches = F.lit(0)
    for kind in ("startup", "tech", "established"):
        if kind in types:
            matches = matches + contains_any(low, [t.lower() for t in terms.get(kind, [])]).cast("int")
    return F.lit(0.5) + matches.cast("double") / F.lit(float(max(1, len(types)))) * 0.5


def overall(profile: dict) -> Column:
    """Weighted sum in the reference's order (not normalised)."""
    w = config.weights(profile)
    return (F.col("skill_score") * w["skill_match_weight"] + F.col("location_score") * w["location_weight"]
            + F.col("salary_score") * w["salary_weight"] + F.col("company_score") * w["company_weight"]
            + F.col("description_score") * w["job_description_weight"])


# ---------------------------------------------------------------- simple model

def simple_description_score(description: Column, profile: dict) -> Column:
    """max(0.1, min(1, keyword share) * (1 - 0.8*excluded share)); no keywords -> 0.7 base."""
    kws = config.get(profile, "keywords", default=[])
    excl = config.get(profile, "excluded_terms", default=[])
    d = F.lower(F.coalesce(description.cast("string"), F.lit("")))
    kw = F.lit(0.7) if not kws else F.least(F.lit(1.0), _ratio(count_contained(d, kws), len(kws)))
    pen = F.lit(0.0) if not excl else _ratio(count_contained(d, excl), len(excl))
    return F.greatest(F.lit(0.1), kw * (F.lit(1.0) - pen * 0.8))


# ---------------------------------------------------------------- own matchers

class Matcher(Protocol):
    """A matcher of one's own for ``score(model=...)``: vectorised, run in Arrow batches on the executors.

    ``columns`` names what it needs of a posting; ``score_batch`` returns the six SCORES for a batch of
    these, row by row.  It must be picklable.
    """

    columns: list[str]

    def score_batch(self, postings: pd.DataFrame, profile: dict) -> pd.DataFrame: ...


def score_by(df: DataFrame, matcher: Matcher, profile: dict) -> DataFrame:
    """``df`` with the scores of an own matcher; only its columns go to Python."""
    names = list(matcher.columns)

    def run(*columns: pd.Series) -> pd.DataFrame:
        batch = pd.DataFrame(dict(zip(names, columns)))
        out = matcher.score_batch(batch, profile)
        if len(out) != len(batch):
            raise ValueError("a matcher returns one row for each posting")
        return out[SCORES].astype("float64")

    # the types are given here, since annotations of a closure's names are not resolved
    run.__annotations__ = {"columns": pd.Series, "return": pd.DataFrame}
    scores = F.pandas_udf(run, ", ".join(f"{c} double" for c in SCORES))
    return df.withColumn("_own", scores(*[F.col(c) for c in names])).select(*df.columns, "_own.*")


# ---------------------------------------------------------------- entry point

def score(df: DataFrame, profile: dict, model: str | Matcher = "full", *, title: str = "title",
          description: str = "description", skills: str = "skills", location: str = "location",
          remote: str = "remote", salary: str = "salary", company: str = "company",
          iso_currency: bool = True, company_terms: dict | None = None, stop_words=None) -> DataFrame:
    """Append the six scores; ``model='simple'`` is the fallback matcher (M10-M15), any other than a name a
    :class:`Matcher`."""
    if not isinstance(model, str):
        return score_by(df, model, profile)
    df = df.drop(*SCORES)  # earlier scores are replaced
    s = F.col(salary)
    cur = sal.to_iso(s["currency"]) if iso_currency else s["currency"]
    sal_score = sal.salary_tier(s["min"], s["max"], cur, config.get(profile, "min_salary", default=0))
    if model == "simple":
        job_skills = F.col(skills)
        out = once(df, skill_score=skill_score(job_skills, profile, exact=True),
                   location_score=location_score(F.col(location), F.col(remote), profile, use_exclusions=False),
                   salary_score=sal_score, company_score=F.lit(0.7),
                   description_score=simple_description_score(F.col(description), profile))
        return once(out, match_score=overall(profile))
    clean = match_text(F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), F.coalesce(F.col(description), F.lit(""))))
    # Text and scores are computed once a row: a filter or sort on a score would repeat their expressions otherwise.
    out = once(df, _clean=clean)
    out = text_cosine(out, F.col("_clean"), profile, "_cos", stop_words)
    out = once(out, skill_score=skill_score(F.col(skills), profile),
               location_score=location_score(F.col(location), F.col(remote), profile),
               salary_score=sal_score,
               company_score=company_score(F.col(company), profile, company_terms),
               description_score=description_score(F.col("_clean"), F.col("_cos"), profile))
    return once(out.drop("_clean", "_cos"), match_score=overall(profile))


def score_profiles(df: DataFrame, profiles: dict[str, dict], model: str = "full", **kw) -> DataFrame:
    """J5 for many profiles: one row per posting and profile (columns ``profile`` and the scores).

    The postings are read once; every profile's scores are expressions of the same row, which
    is then exploded.  Profiles are configuration, so their number is small.
    """
    keep = df.columns
    structs = []
    for i, (name, profile) in enumerate(profiles.items()):
        scored = score(df.select(*keep, *[f"_p{j}" for j in range(i)]), profile, model, **kw)
        df = scored.withColumn(f"_p{i}", F.struct(F.lit(name).alias("profile"), *SCORES)).drop(*SCORES)
        structs.append(F.col(f"_p{i}"))
    return df.select(*keep, F.explode(F.array(*structs)).alias("_p")).select(*keep, "_p.*")
