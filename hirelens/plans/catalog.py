"""Registered queries: one per operator family of the inventory, bound to the driver tables.

Each query takes (spark, sf_dir) and reads whole tables.  Output columns are
flat (arrays joined to text, structs split) and doubles are rounded to 6 places
so that the DuckDB oracle in :mod:`hirelens.plans.oracle` can be compared by value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.functions import dates, fmt, salary, skills, text
from hirelens.operators import dedup, dictionary, load, load_batches, normalize, notify_log, pages, profiles, rank, report, scoring, search, text_index, validate
from hirelens.plans import pipelines
from hirelens.session import drop_path, scratch_path
from hirelens.sources import boards, postings as src
from hirelens.sources.tables import doc_postings, doc_profiles, order_postings, table
from hirelens.streaming import ingest

# ------------------------------------------------------------------ bindings
# Profiles whose terms occur in the driver tables (the shipped profile's terms do not).
DOC_PROFILE = {
    "skills": {"must_have": ["de", "der", "rewh"], "nice_to_have": ["la", "und", "tion", "orre"]},
    "locations": {"remote": True, "countries": ["remote"], "exclude_regions": []},
    "min_salary": 5000,
    "keywords": ["de la", "der", "thatin", "ononst", "que"],
    "excluded_terms": ["und", "el"],
    "company_types": ["startup", "tech", "established"],
}
DOC_DICTIONARY = ["that", "with", "this", "from", "de", "und", "la", "c++", "go", "ai", "java", "ed", "tion"]

ORDER_PROFILE = {
    "skills": {"must_have": ["ring", "widget", "gear"], "nice_to_have": ["red", "blue", "gizmo", "anvil"]},
    "locations": {"remote": True, "countries": ["NATION_1", "NATION_7", "EUROPE"], "exclude_regions": ["ASIA"]},
    "min_salary": 200000,
    "keywords": ["ring", "widget", "small", "hot gear", "red"],
    "excluded_terms": ["bolt", "cold"],
    "company_types": ["startup", "tech", "established"],
    "scoring": {"skill_match_weight": 0.4, "location_weight": 0.2, "salary_weight": 0.2,
                "company_weight": 0.1, "job_description_weight": 0.1},
}
ORDER_COMPANY_TERMS = {"startup": ["household"], "tech": ["machinery", "automobile"],
                       "established": ["building", "furniture"]}
ORDER_DICTIONARY = ["ring", "gear", "plate", "rod", "anvil", "hot gear"]
RUN_DATE = "2025-01-01"
SEARCH = {"job_types": ["order 1-urgent", "order 3-medium"], "locations": ["EUROPE", "NATION_1"],
          "keywords": ["ring", "widget"], "max_results": 100}
PAGE_LINKS = {"tag": "a", "css_class": None, "attr": "href", "sep": "/", "part": 1}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _salary_cols(c: str = "salary"):
    s = F.col(c)
    return [s["min"].alias("salary_min"), s["max"].alias("salary_max"),
            s["currency"].alias("salary_currency"), s["period"].alias("salary_period")]


# ------------------------------------------------------------------ stages over the adapters

def doc_valid(spark, sf) -> DataFrame:
    return validate.valid(doc_postings(spark, sf))


def order_cleaned(spark, sf) -> DataFrame:
    """Orders adapter -> validate -> exact dedup -> normalise (cleaned rows only)."""
    ok, _ = pipelines.clean(order_postings(spark, sf), near_dedup=False, dictionary=ORDER_DICTIONARY)
    return ok


def order_scored(spark, sf, model: str = "full") -> DataFrame:
    return pipelines.match(order_cleaned(spark, sf), ORDER_PROFILE, model, company_terms=ORDER_COMPANY_TERMS)


def doc_cleaned(spark, sf) -> DataFrame:
    ok, _ = pipelines.clean(doc_postings(spark, sf), near_dedup=False, dictionary=DOC_DICTIONARY)
    return ok


def doc_scored(spark, sf) -> DataFrame:
    return pipelines.match(doc_cleaned(spark, sf), DOC_PROFILE)


# ------------------------------------------------------------------ queries: documents

def q_f5_validate(spark, sf):
    p = doc_postings(spark, sf)
    return p.select("input_seq", validate.reject_reason().alias("reject_reason"))


def q_a6_batch_metrics(spark, sf):
    return validate.batch_metrics(validate.with_reject_reason(doc_postings(spark, sf)))


def q_d1_dedup_exact(spark, sf):
    kept = dedup.dedup_exact(doc_valid(spark, sf))
    return kept.select("input_seq", dedup.signature().alias("signature"))


def q_d3_dedup_near(spark, sf):
    kept = dedup.dedup_near(doc_valid(spark, sf))
    return kept.select("input_seq", "source")


def q_d2_pair_similarity(spark, sf):
    """Similarity of every verified near-duplicate edge (later, earlier)."""
    v = doc_valid(spark, sf)
    t = v.select("input_seq", "title", "description")
    e = src.write_table(dedup.similar_edges(t).select("l_seq", "e_seq", "similarity"), _scratch(spark, "edges"))
    # A pair has the similarity of its check, unless an id repeats: then every pairing of its rows counts.
    twice = src.write_table(t.groupBy("input_seq").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("input_seq"), _scratch(spark, "repeated"))
    some = (e.select("l_seq", "e_seq").join(twice.withColumnRenamed("input_seq", "l_seq"), "l_seq", "left_semi")
            .unionByName(e.select("l_seq", "e_seq").join(twice.withColumnRenamed("input_seq", "l_seq"), "l_seq", "left_anti")
                         .join(twice.withColumnRenamed("input_seq", "e_seq"), "e_seq", "left_semi")))
    j = (some.join(t.select(F.col("input_seq").alias("l_seq"), F.col("title").alias("lt"), F.col("description").alias("ld")), "l_seq")
         .join(t.select(F.col("input_seq").alias("e_seq"), F.col("title").alias("et"), F.col("description").alias("ed")), "e_seq"))
    sure = (e.join(twice.withColumnRenamed("input_seq", "l_seq"), "l_seq", "left_anti")
            .join(twice.withColumnRenamed("input_seq", "e_seq"), "e_seq", "left_anti"))
    return rounded(sure.select("l_seq", "e_seq", "similarity")
                   .unionByName(j.select("l_seq", "e_seq", dedup.pair_similarity("lt", "et", "ld", "ed").alias("similarity"))))


def q_p2_clean_text(spark, sf):
    p = doc_postings(spark, sf)
    return p.select("input_seq", text.clean_text("title").alias("title_clean"),
                    text.clean_text("description").alias("description_clean"))


def q_p8_doc_skills(spark, sf):
    p = doc_postings(spark, sf)
    sk = skills.extract_skills([], F.col("description"), DOC_DICTIONARY)
    return p.select("input_seq", F.array_join(sk, ",").alias("skills"))


def q_p8_dictionary_table(spark, sf):
    """P8 for a dictionary table: the words and two-word phrases of all benchmark items and the terms of P8_doc_skills."""
    words = F.split(F.lower("text"), " ")
    listed = table(spark, sf, "benchmark").select(F.explode(F.array(words)).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    phrases = F.zip_with(F.slice("w", 1, n), F.slice("w", 2, n), lambda a, b: F.concat_ws(" ", a, b))
    terms = listed.select(F.explode(F.concat("w", phrases)).alias("term")).unionByName(spark.createDataFrame([(t,) for t in DOC_DICTIONARY], "term string"))
    out = dictionary.extract_skills_table(doc_postings(spark, sf).select("input_seq", "description"), terms)
    return out.select("input_seq", F.size("skills").alias("n_skills"), F.md5(F.array_join("skills", ",").cast("binary")).alias("skills_md5"))


def q_p11_doc_salary(spark, sf):
    p = doc_postings(spark, sf).select("input_seq", salary.parse_salary_text(F.col("description")).alias("salary"))
    return p.filter(F.col("salary").isNotNull()).select(
        "input_seq", *_salary_cols(), salary.salary_parse_failed(F.col("salary")).alias("failed"))


def q_m2_text_cosine(spark, sf):
    p = doc_postings(spark, sf)
    clean = text.match_text(F.concat_ws(" ", F.col("title"), F.col("description")))
    out = scoring.text_cosine(p.withColumn("_c", clean), F.col("_c"), DOC_PROFILE, "cosine")
    return rounded(out.select("input_seq", "cosine"))


def q_m4_description_score(spark, sf):
    p = doc_postings(spark, sf)
    clean = text.match_text(F.concat_ws(" ", F.col("title"), F.col("description")))
    out = scoring.text_cosine(p.withColumn("_c", clean), F.col("_c"), DOC_PROFILE, "_cos")
    return rounded(out.select("input_seq", scoring.description_score(F.col("_c"), F.col("_cos"), DOC_PROFILE)
                              .alias("description_score")))


def q_flagship(spark, sf):
    """documents -> validate -> exact dedup -> normalise -> score -> top 20."""
    return rounded(rank.top_k(doc_scored(spark, sf), 20).select("input_seq", "source", *scoring.SCORES))


# ------------------------------------------------------------------ queries: orders adapter

def q_p14_normalize(spark, sf):
    c = order_cleaned(spark, sf)
    return rounded(c.select(
        "input_seq", "id", "title", "company", "location", "description", "url", "remote", "source",
        "posted_date", F.array_join("skills", ",").alias("skills"), *_salary_cols(),
        "employment_type", "company_size", "company_industry", "company_description", "city", "job_type",
        "client_rating", "client_jobs_posted", "engagement_duration", "weekly_hours", "category", "category_group"))


def q_p7_posted_date(spark, sf):
    p = order_postings(spark, sf)
    return p.select("input_seq", "date_posted", dates.parse_posted_date("date_posted").alias("posted_date"))


def q_p1_source(spark, sf):
    p = normalize.conform(order_postings(spark, sf))
    return p.select("input_seq", normalize.detect_source(p).alias("source"))


def _as_json(p: DataFrame):
    """The raw posting as its source's JSON record (nested client and duration, absent keys for nulls)."""
    nested = {"client_name": F.when(F.col("client_name").isNotNull(), F.struct(F.col("client_name").alias("name"))).alias("client"),
              "engagement_duration_label": F.when(F.col("engagement_duration_label").isNotNull(),
                                                  F.struct(F.col("engagement_duration_label").alias("label"))).alias("engagement_duration")}
    return F.to_json(F.struct(*[nested.get(c, F.col(c)) for c in p.columns]))


def q_s1_json_ingest(spark, sf):
    """S1 from JSON Lines files: the orders as records, an unparsable line among them -> VARIANT
    ingest -> normalise (= P14)."""
    root = _scratch(spark, "json-lines")
    p = order_postings(spark, sf)
    p.select(_as_json(p).alias("value")).write.text(root)
    spark.createDataFrame([("{broken",), ("[]",), ("",)], "value string").write.mode("append").text(root)
    # read twice by the clean stage
    raw = src.write_table(src.read_postings_lines(spark, root), _scratch(spark, "raw"))
    ok, _ = pipelines.clean(raw, near_dedup=False, dictionary=ORDER_DICTIONARY)
    return rounded(ok.select("input_seq", "source", "company", "location", "remote", "posted_date",
                             F.array_join("skills", ",").alias("skills"), *_salary_cols()))


def q_f1_record_shape(spark, sf):
    e = table(spark, sf, "events").select("event_id", "props")
    v = F.try_parse_json(F.col("props"))
    return e.select("event_id", src.is_record(v).alias("is_record"),
                    F.try_variant_get(v, "$.k", "bigint").alias("k"))


def q_m9_score_full(spark, sf):
    return rounded(order_scored(spark, sf).select("input_seq", *scoring.SCORES))


def q_m15_score_simple(spark, sf):
    return rounded(order_scored(spark, sf, "simple").select("input_seq", *scoring.SCORES))


def q_t1_rank(spark, sf):
    r = rank.with_dense_rank(order_scored(spark, sf).select("input_seq", "match_score"), rank.ranking_order())
    return rounded(r.select("rank", "input_seq", "match_score"))


def q_t2_top50(spark, sf):
    return rounded(rank.top_k(order_scored(spark, sf), 50).select("input_seq", "match_score"))


def q_t4_notify(spark, sf):
    return rounded(rank.notification_set(order_scored(spark, sf), 0.5, 10).select("input_seq", "match_score"))


def q_a1_summary(spark, sf):
    return rounded(report.summary(order_scored(spark, sf)))


def q_a2_sources(spark, sf):
    return rounded(report.source_counts(order_scored(spark, sf)))


def q_a4_histogram(spark, sf):
    return rounded(report.score_histogram(order_scored(spark, sf)))


def q_a5_skill_frequency(spark, sf):
    return report.skill_frequency(order_cleaned(spark, sf))


def q_t5_top_skills(spark, sf):
    return report.top_skills(order_cleaned(spark, sf), 15)


def q_a7_distinct_skills(spark, sf):
    return report.distinct_skills(order_cleaned(spark, sf))


def q_x7_display(spark, sf):
    return rounded(report.display_rows(order_scored(spark, sf), 20))


def q_s9_listings(spark, sf):
    t = pipelines.save_tables(order_scored(spark, sf), RUN_DATE)["job_listings"]
    return rounded(t.select(*[c for c in load.LISTING_COLUMNS]))


def q_s9_second_load(spark, sf):
    """Two daily loads keyed by (source, external_id): even orders first, then all of them."""
    # both loads read it
    scored = src.write_table(order_scored(spark, sf), _scratch(spark, "scored"))
    first = load.load_listings(scored.filter("input_seq % 2 = 0"), "2024-12-31").select("id", "source", "external_id", "posted_date", "match_score")
    path = _scratch(spark, "listings")
    first.write.parquet(path)
    first = spark.read.parquet(path)
    top = first.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    second = load.load_listings(scored, RUN_DATE, int(top) + 1, existing=first).select(*first.columns)
    return rounded(first.unionByName(second))


def q_s10_skills_dim(spark, sf):
    return pipelines.save_tables(order_scored(spark, sf), RUN_DATE)["skills"]


def q_s11_job_skills(spark, sf):
    return pipelines.save_tables(order_scored(spark, sf), RUN_DATE)["job_skills"]


def q_s12_client_details(spark, sf):
    return rounded(pipelines.save_tables(order_scored(spark, sf), RUN_DATE)["client_details"])


def q_s2_search(spark, sf):
    c = order_cleaned(spark, sf)
    r = search.search(c, SEARCH["job_types"], SEARCH["locations"], SEARCH["keywords"], SEARCH["max_results"])
    return r.select("criterion", "result_pos", "input_seq")


def q_s2_indexed_search(spark, sf):
    """S2 for a table of criteria (every title type with every country) over the q-gram index."""
    c = order_cleaned(spark, sf).select("input_seq", "title", "location", "description")
    path = _scratch(spark, "text-index")
    text_index.write_index(c, path)
    kinds = table(spark, sf, "orders").select(F.concat(F.lit("order "), F.lower("o_orderpriority")).alias("title")).distinct()
    places = [r[0] for r in table(spark, sf, "nation").select("n_name").collect()]  # 25 rows by definition
    grid = kinds.select("title", F.explode(F.array(*map(F.lit, places))).alias("location"))
    grid = grid.withColumns({"criterion": F.concat_ws(" @ ", "title", "location"), "keywords": F.array(*map(F.lit, SEARCH["keywords"]))})
    return text_index.search_index(spark, path, grid, SEARCH["max_results"]).withColumnRenamed("seq", "input_seq")


def q_j6_not_notified(spark, sf):
    """Rows qualifying for notification that were not in yesterday's mail (its top 10)."""
    scored = order_scored(spark, sf)
    sent = load.mark_notified(rank.notification_set(scored, 0.5, 10), None, RUN_DATE)
    fresh = load.not_yet_notified(scored, sent)
    return rounded(rank.notification_set(fresh, 0.5, 10).select("input_seq", "match_score"))


def q_s6_s7_csv_roundtrip(spark, sf):
    """Cleaned rows written as CSV (S6) and read back typed."""
    path = _scratch(spark, "cleaned-csv")
    c = order_cleaned(spark, sf).select("input_seq", "id", "title", "source", "remote", "skills", "salary")
    src.write_cleaned(c, path)
    back = src.read_cleaned(spark, path)
    return back.select(F.col("input_seq").cast("bigint"), "id", "title", "source",
                       fmt.text_bool("remote").alias("remote"), F.array_join("skills", ",").alias("skills"),
                       *_salary_cols())


def q_s8_top_csv(spark, sf):
    """Top 50 written as the export CSV (S8) and parsed back with the load-time rules."""
    path = _scratch(spark, "top-csv")
    src.write_top(order_scored(spark, sf).select("input_seq", "id", "source", "remote", "posted_date", "skills",
                                                 "salary", *scoring.SCORES), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rounded(_s8_back(back))


def _s8_back(back: DataFrame) -> DataFrame:
    t = back.withColumn("input_seq", F.col("input_seq").cast("bigint"))
    sal = fmt.salary_from_text(F.col("salary"))
    return t.select("input_seq", F.coalesce("id", F.lit("")).alias("external_id"),
                    fmt.text_bool("remote").alias("remote"),
                    dates.default_date("posted_date", RUN_DATE).alias("posted_date"),
                    sal["min"].alias("salary_min"), sal["currency"].alias("salary_currency"),
                    F.array_join(skills.split_csv("skills"), "|").alias("skills"),
                    *[fmt.number_or_zero(c).alias(c) for c in scoring.SCORES])


def q_s6_cleaned_parquet(spark, sf):
    """The canonical hand-off: the cleaned table written once as Parquet and read back."""
    back = src.write_cleaned_parquet(order_cleaned(spark, sf), _scratch(spark, "cleaned"))
    return back.select("input_seq", "id", "source", "title", "remote", "posted_date",
                       F.array_join("skills", ",").alias("skills"), *_salary_cols())


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


#: Records of one JSON-array file, about: files grow in number with the table, not in size.
ARRAY_RECORDS = 10_000


def q_s1_json_arrays(spark, sf):
    """S1 from files: the orders of each source as JSON-array files (one array per file), a
    corrupt and a missing one among them, read back in byte ranges and cleaned (validated, copies
    over all files dropped, normalised)."""
    root = _scratch(spark, "json-arrays")
    p = order_postings(spark, sf).filter(F.col("source").isin("linkedin", "upwork"))
    files_ = -(-p.count() // ARRAY_RECORDS) or 1
    arrays = (p.withColumn("bucket", F.pmod(F.xxhash64("input_seq"), F.lit(files_))).groupBy(F.col("source").alias("kind"), "bucket")
              .agg(F.concat(F.lit("["), F.array_join(F.collect_list(_as_json(p)), ","), F.lit("]")).alias("value")))
    arrays.write.partitionBy("kind", "bucket").text(root)
    spark.createDataFrame([("[{",)], "value string").write.text(f"{root}/broken")
    files = {"linkedin": f"{root}/kind=linkedin", "broken": f"{root}/broken", "gone": f"{root}/none", "upwork": f"{root}/kind=upwork"}
    raw = src.write_table(src.read_postings(spark, files), _scratch(spark, "raw"))
    ok, _ = pipelines.clean(raw, near_dedup=False, dictionary=ORDER_DICTIONARY)
    return rounded(ok.select("id", "source", "company", "location", "remote", "posted_date",
                             F.array_join("skills", ",").alias("skills"), *_salary_cols()))


def q_s4_raw_landing(spark, sf):
    """The raw batch of two days appended to the landing folder and read back."""
    root = _scratch(spark, "landing")
    p = order_postings(spark, sf)
    for day in ("2025-01-01", "2025-01-02"):
        src.write_raw(p.select("id", "source", "title", "url"), root, day)
    back = src.read_raw(spark, root, "id string, title string, url string, source string, load_date date")
    return back.select("id", "source", "load_date", "title", "url")


def q_s5_fresh(spark, sf):
    """Rows of files that are fresh a minute, or two days, after they landed, or if forced."""
    root, schema = _scratch(spark, "landing"), "id string, source string, load_date date"
    src.write_raw(order_postings(spark, sf).select("id", "source"), root, "2025-01-01")
    now = spark.sql("SELECT date_format(current_timestamp() + INTERVAL 1 MINUTE, 'yyyy-MM-dd HH:mm:ss') AS a, "
                    "date_format(current_timestamp() + INTERVAL 2 DAYS, 'yyyy-MM-dd HH:mm:ss') AS b").first()
    parts = {"fresh": src.read_fresh(spark, root, 24, now=now.a, schema=schema), "stale": src.read_fresh(spark, root, 24, now=now.b, schema=schema),
             "forced": src.read_fresh(spark, root, 24, force=True, schema=schema)}
    out = None
    for name, df in parts.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("what"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def q_j5_profiles(spark, sf):
    """J5/T4 for several profiles: the ten best postings of each."""
    salary_only = {**ORDER_PROFILE, "scoring": {"skill_match_weight": 0.0, "location_weight": 0.0, "salary_weight": 1.0,
                                                "company_weight": 0.0, "job_description_weight": 0.0}}
    scored = scoring.score_profiles(order_cleaned(spark, sf), {"full": ORDER_PROFILE, "salary": salary_only}, company_terms=ORDER_COMPANY_TERMS)
    return rounded(rank.top_k_per_group(scored, 10, "profile").select("profile", "input_seq", "rank", "match_score"))


def q_j5_profile_table(spark, sf):
    """J5 for a table of profiles (one a document): the ten best postings of each."""
    best = profiles.top_postings(doc_cleaned(spark, sf), doc_profiles(spark, sf), 10)
    return rounded(best.select("profile", "input_seq", "rank", "match_score"))


def q_f6_rejects(spark, sf):
    """Rejects of the clean stage over the documents: validation reasons and unparsable salaries."""
    _, bad = pipelines.clean(doc_postings(spark, sf), near_dedup=False, dictionary=DOC_DICTIONARY)
    return bad


def q_a6_stage_metrics(spark, sf):
    return pipelines.clean_metrics(doc_postings(spark, sf), near_dedup=False, dictionary=DOC_DICTIONARY)


def q_a6_observed(spark, sf):
    """A6 for the documents' clean stage and the load of the text export, observed while the stages are written."""
    _, _, steps = pipelines.clean_observed(doc_postings(spark, sf), _scratch(spark, "observed"), dictionary=DOC_DICTIONARY)
    _, _, loaded = pipelines.load_observed(_text_export(spark, order_scored(spark, sf)), _scratch(spark, "loaded"), RUN_DATE)
    return spark.createDataFrame(steps + loaded, "stage string, n_in long, n_out long, n_dropped long")


EXPORTED = ["input_seq", "id", "title", "description", "source", "url", "location", "city", "company", "job_type", "employment_type", *scoring.SCORES]


def _text_export(spark, s: DataFrame) -> DataFrame:
    """The scored orders as a CSV export read back as text, some cells of it spoilt."""
    n, text = F.col("input_seq"), lambda c: F.col(c).cast("string")
    spoilt = {"match_score": F.when(n % 11 == 0, "n/a").when(n % 19 == 0, "").otherwise(text("match_score")),
              "salary_score": F.when(n % 13 == 0, "1e20").otherwise(text("salary_score")),
              "posted_date": F.when(n % 17 == 0, "soon").otherwise(text("posted_date")),
              "salary": F.to_json("salary"), "skills": F.array_join("skills", ","), "remote": text("remote")}
    path = _scratch(spark, "text-export")
    # a file with line ends in its cells is one task to read, compressed or not
    (s.select(*[c for c in EXPORTED if c not in spoilt], *[v.alias(c) for c, v in spoilt.items()])
     .write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return back.withColumn("input_seq", F.col("input_seq").cast("bigint"))


def q_s9_load_rejects(spark, sf):
    """S9/X12 from text: the rows that load, with exact figures, and those that do not, with the reason."""
    # read by the export and for the exact scores, which alone stay
    path = _scratch(spark, "scored")
    scored = src.write_table(order_scored(spark, sf).select(*EXPORTED, "posted_date", "salary", "skills", "remote"), path)
    exact = src.write_table(scored.select("input_seq", F.col("match_score").alias("s")), _scratch(spark, "exact"))
    text = _text_export(spark, scored)
    drop_path(spark, path)
    listings, bad = load.load_text(text, RUN_DATE)
    ok = listings.join(exact, "input_seq").select("input_seq", F.lit("loaded").alias("status"), F.lit(None).cast("string").alias("reject_value"), "posted_date",
                                                  (F.abs(F.col("match_score") - F.col("s")) < 0.000051).alias("exact"))
    return ok.unionByName(bad.select("input_seq", F.concat_ws(": ", "reject_column", "reject_reason").alias("status"), "reject_value",
                                     F.lit(None).cast("date").alias("posted_date"), F.lit(None).cast("boolean").alias("exact")))


def q_s9_batches(spark, sf):
    """Two loads at the same time (even orders, all orders), both staged before either is written, and a replay of the first."""
    scored = src.write_table(order_scored(spark, sf), _scratch(spark, "scored"))
    root = _scratch(spark, "batches")
    one = load_batches.stage(scored.filter("input_seq % 2 = 0"), root, "one", "2024-12-31")
    two = load_batches.stage(scored, root, "two", RUN_DATE)
    first, second = load_batches.reserve(spark, root, "one", *one), load_batches.reserve(spark, root, "two", *two)
    load_batches.commit(spark, root, second)
    load_batches.commit(spark, root, first)
    load_batches.load_batch(scored.filter("input_seq % 2 = 0"), root, "one", "2024-12-31")
    return load_batches.loaded(spark, root).select("batch", "id", "source", "external_id", "posted_date")


class KeywordMatcher:
    """An own matcher: the share of the profile's keywords and of its must-have terms in the description."""

    columns = ["description", "remote"]

    def score_batch(self, postings, profile):
        text = postings["description"].fillna("").str.lower()
        share = lambda terms: sum(text.str.contains(t.lower(), regex=False).astype(float) for t in terms) / max(1, len(terms))
        out = {"skill_score": share(profile["skills"]["must_have"]), "location_score": postings["remote"].fillna(False).astype(float), "salary_score": 0.0 * text.str.len(),
               "company_score": 0.0 * text.str.len(), "description_score": share(profile["keywords"])}
        frame = text.to_frame("t").assign(**out)
        return frame.assign(match_score=frame["skill_score"] * 0.5 + frame["description_score"] * 0.5)


def q_m9_own_matcher(spark, sf):
    """Extension point: the orders scored by a matcher of one's own."""
    return rounded(scoring.score(order_cleaned(spark, sf), ORDER_PROFILE, KeywordMatcher()).select("input_seq", *scoring.SCORES))


def q_s2_job_board(spark, sf):
    """Extension point: the search of S2_search through a job board as a data source, with a filter that the board takes."""
    path = _scratch(spark, "board")
    order_cleaned(spark, sf).select("input_seq", "title", "location", "description").write.parquet(path)
    found = boards.read_board(spark, "hirelens.sources.boards:TableBoard", {"path": path}, SEARCH["job_types"], SEARCH["locations"], SEARCH["keywords"], SEARCH["max_results"])
    return found.filter(F.col("title").contains("building")).select("criterion", "input_seq")


def q_x1_percent_text(spark, sf):
    return order_scored(spark, sf).select("input_seq", fmt.score_percent("match_score").alias("match_text"), fmt.score_percent("description_score").alias("description_text"))


def q_j6_once_per_profile(spark, sf):
    """J6 for two profiles over three epochs, the second one run twice: what each epoch sent."""
    salary_only = {**ORDER_PROFILE, "scoring": {**dict.fromkeys(ORDER_PROFILE["scoring"], 0.0), "salary_weight": 1.0}}
    scored = scoring.score_profiles(order_cleaned(spark, sf), {"full": ORDER_PROFILE, "salary": salary_only}, company_terms=ORDER_COMPANY_TERMS)
    scored = src.write_table(scored.select("profile", "id", "input_seq", "match_score"), _scratch(spark, "scored"))
    log, out = _scratch(spark, "notified"), None
    for turn, (epoch, day) in enumerate([(1, "2025-01-01"), (2, "2025-01-02"), (2, "2025-01-02"), (3, "2025-01-03")]):
        sent = notify_log.notify_once(scored, log, epoch, day).select(F.lit(turn).alias("turn"), "profile", "id", "rank", "notified_on")
        out = sent if out is None else out.unionByName(sent)
    return out


#: Ends of the event times of the landings of S4_stream_dedup.
LANDINGS = ["1997-01-01", "1999-01-01", "2001-01-01", "2003-01-01", "2100-01-01"]


def q_s4_stream_dedup(spark, sf):
    """Streaming S4/D1 with bounded state: five landings of the orders by event time, each run when it has landed.  A
    third of the orders come again a day later (dropped), some of the early ones 1,600 days later (new postings), and
    in the last landing changed ones from before 2000 (late, dropped)."""
    landing, out, state = (_scratch(spark, f"stream-{x}") for x in ("landing", "out", "state"))
    p = order_postings(spark, sf)
    days = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("day"))
    source = _scratch(spark, "stream-source")
    p = src.write_table(p.join(days, p["input_seq"] == days["k"]).select(p["*"], "day"), source)
    n = F.col("input_seq")
    copies = [(p, 0), (p.filter(n % 3 == 0), 1), (p.filter((n % 7 == 0) & (F.col("day") < "1999-01-01")), 1600)]
    rows, late = None, p.filter((n % 10 == 1) & (F.col("day") < "2000-01-01")).withColumn("title", F.concat(F.lit("Changed "), "title"))
    for df, shift in copies:
        c = df.withColumn("collected_on", F.date_add("day", shift)).withColumn("landing", F.col("collected_on"))
        rows = c if rows is None else rows.unionByName(c)
    rows = rows.unionByName(late.withColumn("collected_on", F.col("day")).withColumn("landing", F.lit("2099-01-01").cast("date")))
    rows = rows.withColumn("collected_at", F.concat(F.col("collected_on").cast("string"), F.lit("T00:00:00Z"))).drop("day", "collected_on")
    # dealt into the landings in one pass
    low, number = F.lit("0001-01-01"), None
    for i, high in enumerate(LANDINGS):
        here = (F.col("landing") >= low) & (F.col("landing") < high)
        number, low = F.when(here, i) if number is None else number.when(here, i), F.lit(high)
    dealt = _scratch(spark, "stream-landings")
    rows = rows.withColumn("number", number).filter("number is not null").drop("landing")
    rows.write.partitionBy("number").parquet(dealt)
    drop_path(spark, source)
    rows = spark.read.schema(rows.schema).parquet(dealt)
    for i in range(len(LANDINGS)):
        part = rows.filter(F.col("number") == i).drop("number")
        part.select(_as_json(part).alias("value")).write.mode("append").option("compression", "gzip").text(landing)
        ingest.run_available(spark, landing, out, state, lambda b: b.select("input_seq", "title", F.col("event_time").cast("date").alias("collected_on")),
                             columns=["input_seq", "title"])
    return spark.read.schema("input_seq long, title string, collected_on date, batch int").parquet(out).select("input_seq", "title", "collected_on")


def q_s13_listing_ids(spark, sf):
    return pages.extract_listing_ids(table(spark, sf, "pages"), **PAGE_LINKS)


def q_s14_page_fields(spark, sf):
    return pages.page_fields_regex(table(spark, sf, "pages"))


def q_s14_page_details(spark, sf):
    return pages.page_details(table(spark, sf, "pages"))


QUERIES = {
    "F5_validate": q_f5_validate,
    "A6_batch_metrics": q_a6_batch_metrics,
    "D1_dedup_exact": q_d1_dedup_exact,
    "D2_pair_similarity": q_d2_pair_similarity,
    "D3_dedup_near": q_d3_dedup_near,
    "P2_clean_text": q_p2_clean_text,
    "P8_doc_skills": q_p8_doc_skills,
    "P8_dictionary_table": q_p8_dictionary_table,
    "P11_doc_salary": q_p11_doc_salary,
    "M2_text_cosine": q_m2_text_cosine,
    "M4_description_score": q_m4_description_score,
    "flagship_doc_top20": q_flagship,
    "P1_source": q_p1_source,
    "P7_posted_date": q_p7_posted_date,
    "P14_normalize": q_p14_normalize,
    "S1_json_ingest": q_s1_json_ingest,
    "F1_record_shape": q_f1_record_shape,
    "M9_score_full": q_m9_score_full,
    "M15_score_simple": q_m15_score_simple,
    "T1_rank": q_t1_rank,
    "T2_top50": q_t2_top50,
    "T4_notify": q_t4_notify,
    "A1_summary": q_a1_summary,
    "A2_sources": q_a2_sources,
    "A4_histogram": q_a4_histogram,
    "A5_skill_frequency": q_a5_skill_frequency,
    "T5_top_skills": q_t5_top_skills,
    "A7_distinct_skills": q_a7_distinct_skills,
    "X7_display": q_x7_display,
    "S9_listings": q_s9_listings,
    "S9_second_load": q_s9_second_load,
    "S10_skills_dim": q_s10_skills_dim,
    "S11_job_skills": q_s11_job_skills,
    "S12_client_details": q_s12_client_details,
    "S2_search": q_s2_search,
    "S2_indexed_search": q_s2_indexed_search,
    "J6_not_notified": q_j6_not_notified,
    "S6_S7_csv_roundtrip": q_s6_s7_csv_roundtrip,
    "S8_top_csv": q_s8_top_csv,
    "S6_cleaned_parquet": q_s6_cleaned_parquet,
    "S1_json_arrays": q_s1_json_arrays,
    "S4_raw_landing": q_s4_raw_landing,
    "S5_fresh": q_s5_fresh,
    "J5_profiles": q_j5_profiles,
    "J5_profile_table": q_j5_profile_table,
    "F6_rejects": q_f6_rejects,
    "A6_stage_metrics": q_a6_stage_metrics,
    "A6_observed": q_a6_observed,
    "S9_load_rejects": q_s9_load_rejects,
    "S9_batches": q_s9_batches,
    "M9_own_matcher": q_m9_own_matcher,
    "S2_job_board": q_s2_job_board,
    "X1_percent_text": q_x1_percent_text,
    "J6_once_per_profile": q_j6_once_per_profile,
    "S4_stream_dedup": q_s4_stream_dedup,
    "S13_listing_ids": q_s13_listing_ids,
    "S14_page_fields": q_s14_page_fields,
    "S14_page_details": q_s14_page_details,
}
