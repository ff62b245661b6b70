"""Normalisation of raw postings into the cleaned shape.

Input: a typed table in the union-of-sources raw shape (absent field = null
column or missing column).  Output: the cleaned common fields, the LinkedIn and
Upwork extensions (null for other sources) and ``reject_reason`` for rows the
reference would drop with an error (F6).  One projection, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import config
from hirelens.functions import dates, salary, skills, text

RAW_FIELDS = {
    "id": "string", "title": "string", "description": "string", "description_text": "string",
    "url": "string", "source": "string", "organization": "string", "client_name": "string",
    "company": "string", "locations_derived": "array<string>", "client_country": "string",
    "location": "string", "remote_derived": "boolean", "date_posted": "string", "salary_raw": "string",
    "project_budget_hourly_min": "double", "project_budget_hourly_max": "double",
    "project_budget_total": "double", "project_budget_currency": "string",
    "skills_additional": "array<string>", "skills_occupation": "array<string>", "skills": "array<string>",
    "employment_type": "string", "linkedin_org_size": "string", "linkedin_org_industry": "string",
    "linkedin_org_description": "string", "cities_derived": "array<string>", "project_type": "string",
    "client_score": "double", "client_total_assignments": "bigint", "engagement_duration_label": "string",
    "weekly_hours": "string", "category": "string", "category_group": "string",
}


def conform(df: DataFrame) -> DataFrame:
    """Add every missing raw field as a typed null column (absent key = null)."""
    missing = {k: F.lit(None).cast(t) for k, t in RAW_FIELDS.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def detect_source(df: DataFrame) -> Column:
    """P1: 'linkedin' anywhere in the record (keys of present fields and values),
    else a ``client`` object or an upwork.com url -> 'upwork', else 'unknown'."""
    if "record_text" in df.columns:
        # JSON input: the record's own text, keys included, as the reference's str(job).
        is_li = F.coalesce(F.col("record_text").contains("linkedin"), F.lit(False))
        present = F.coalesce(F.col("client_present"), F.lit(False)) if "client_present" in df.columns \
            else F.col("client_name").isNotNull()
        is_up = present | F.coalesce(F.col("url").contains("upwork.com"), F.lit(False))
        return F.when(is_li, "linkedin").when(is_up, "upwork").otherwise("unknown")
    texts, present = [], []
    for f in df.schema.fields:
        if f.name in ("input_seq", "record_ok"):
            continue
        if "linkedin" in f.name.lower():
            present.append(F.col(f.name).isNotNull())
        if isinstance(f.dataType, T.StringType) or (
                isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)):
            texts.append(F.col(f.name))
    # One pass over all text values (the separator cannot join two halves of 'linkedin').
    checks = present + ([F.lower(F.concat_ws("\u0001", *texts)).contains("linkedin")] if texts else [])
    is_li = reduce(lambda a, b: a | b, checks) if checks else F.lit(False)
    is_up = F.col("client_name").isNotNull() | F.coalesce(F.col("url").contains("upwork.com"), F.lit(False))
    return F.when(is_li, "linkedin").when(is_up, "upwork").otherwise("unknown")


def raw_location(country_there: Column | None = None) -> Column:
    """P4 before cleaning: first 3 derived locations, client country, location, 'Remote'.  A client country that is
    there as a null (``country_there``) is an empty location."""
    ld = F.col("locations_derived")
    country_there = F.col("client_country").isNotNull() if country_there is None else country_there
    return (F.when(F.coalesce(F.size(ld), F.lit(0)) > 0, F.array_join(F.slice(ld, 1, 3), ", "))
            .when(country_there, F.coalesce("client_country", F.lit("")))
            .otherwise(F.coalesce(F.col("location"), F.lit("Remote"))))


def raw_description() -> Column:
    """P5 before cleaning: ``description_text``, else ``description``, else ''."""
    return F.coalesce(F.col("description_text"), F.col("description"), F.lit(""))


def flag(df: DataFrame, name: str, otherwise: Column) -> Column:
    """A presence flag of JSON input (key there, even with a null value), else ``otherwise``."""
    return F.coalesce(F.col(name), F.lit(False)) if name in df.columns else otherwise


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with columns that are computed once per row, however often they are used.

    A one-element ``explode`` keeps Catalyst from merging the projections (which would
    repeat each expression wherever its column is used) and keeps generated methods small.  The
    expressions stand in a projection below it, which is compiled: a generator's own ones are
    interpreted as soon as one of them has no generated code.
    """
    d = df.withColumn("_cols", F.struct(*[c.alias(n) for n, c in cols.items()]))
    d = d.select(*df.columns, F.explode(F.array("_cols")).alias("_once"))
    return d.select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in cols])


def normalize(df: DataFrame, dictionary: list[str] = skills.TECH_SKILLS, prefer_iso: bool = False) -> DataFrame:
    """P1-P14 over raw postings; adds ``reject_reason`` = 'salary_unparsable' for F6 rows.

    Shared inputs first (source, location, description; then the salary), each once per
    row, then the rules.  JSON input carries presence flags, because a key with a null
    value is not an absent key: such a ``remote_derived`` is false, such an hourly
    maximum a reject, such a ``project_type`` null, such a ``client_country`` an empty location.
    """
    df = conform(df)
    remote_there = flag(df, "remote_present", F.col("remote_derived").isNotNull())
    client_object = flag(df, "client_is_object", F.col("client_name").isNotNull())
    max_null = flag(df, "hourly_max_null", F.lit(False))
    type_there = flag(df, "project_type_present", F.col("project_type").isNotNull())
    country_there = flag(df, "client_country_present", F.col("client_country").isNotNull())
    category_there = flag(df, "category_present", F.col("category").isNotNull())
    df = once(df, _src=detect_source(df), _desc=raw_description(), _low=F.lower(raw_description()), _loc=raw_location(country_there))
    li, up = F.col("_src") == "linkedin", F.col("_src") == "upwork"
    # The salary text is salary_raw when it parses, else the description.
    raw, text_sal = (F.when(li, salary.parse_salary_text(F.col(c), prefer_iso)) for c in ("salary_raw", "_desc"))
    up_sal = salary.upwork_salary("project_budget_hourly_min", "project_budget_hourly_max",
                                  "project_budget_total", "project_budget_currency", max_null)
    df = once(df, _items=skills.skill_items([F.col("skills_additional"), F.col("skills_occupation"), F.col("skills")], F.col("_low"), dictionary))
    # beside the salary, whose lambdas make Spark cut this projection into small methods
    df = once(df, _sal=F.when(li, F.coalesce(raw, text_sal)).when(up, up_sal).otherwise(F.lit(None).cast(salary.SALARY_TYPE)),
              _sk=skills.sorted_items(F.col("_items")))
    company = (F.when(F.col("organization").isNotNull(), F.col("organization"))
               .when(client_object, F.coalesce(F.col("client_name"), F.lit("")))
               .otherwise(F.coalesce(F.col("company"), F.lit(""))))
    remote = F.when(remote_there, F.coalesce(F.col("remote_derived"), F.lit(False))).otherwise(
        text.contains_any(F.lower(F.concat_ws(" ", F.col("_loc"), F.col("_desc"))), config.REMOTE_TERMS))
    out = df.select(
        *([F.col("input_seq")] if "input_seq" in df.columns else []),
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
        text.clean_text(F.col("title")).alias("title"),
        text.clean_text(company).alias("company"),
        text.clean_text(F.col("_loc")).alias("location"),
        text.clean_text(F.col("_desc")).alias("description"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        remote.alias("remote"),
        F.col("_src").alias("source"),
        dates.parse_posted_date(F.col("date_posted")).alias("posted_date"),
        F.col("_sk").alias("skills"),
        F.col("_sal").alias("salary"),
        F.when(li, F.col("employment_type")).alias("employment_type"),
        F.when(li, F.col("linkedin_org_size")).alias("company_size"),
        F.when(li, F.col("linkedin_org_industry")).alias("company_industry"),
        F.when(li, text.clean_text(F.col("linkedin_org_description"))).alias("company_description"),
        F.when(li, F.try_element_at(F.col("cities_derived"), F.lit(1))).alias("city"),
        F.when(up & ~type_there, F.lit("Contract")).when(up, F.col("project_type")).alias("job_type"),
        F.when(up, F.col("client_score")).alias("client_rating"),
        F.when(up, F.col("client_total_assignments")).alias("client_jobs_posted"),
        F.when(up, F.col("engagement_duration_label")).alias("engagement_duration"),
        F.when(up, F.col("weekly_hours")).alias("weekly_hours"),
        F.when(up & category_there, F.col("category")).alias("category"),
        F.when(up & category_there, F.col("category_group")).alias("category_group"),
    )
    return out.withColumn("reject_reason",
                          F.when(salary.salary_parse_failed(F.col("salary")), F.lit("salary_unparsable")))


def split_normalized(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, F6 rejects) of :func:`normalize` output."""
    ok = df.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = df.filter(F.col("reject_reason").isNotNull())
    return ok, bad
