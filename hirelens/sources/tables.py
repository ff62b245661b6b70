"""Driver tables (one parquet file each) and the postings views derived from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; Catalyst prunes columns and pushes filters into the parquet scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def doc_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text postings from ``documents``: every document, whole text.

    title = first line of the text, description = the whole text, source from the
    language, url from the text's hash (copies share it, as D1 needs).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    source = (F.when(F.col("lang") == "en", "linkedin").when(F.col("lang") == "fr", "upwork")
              .when(F.col("lang") == "de", "indeed").otherwise(F.col("lang")))
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id").alias("input_seq"),
        F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("description"),
        source.alias("source"),
        F.concat(F.lit("https://www."), source, F.lit(".com/jobs/"), F.substring(F.md5(F.col("text")), 1, 12)).alias("url"),
    )


def doc_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile table from ``documents``, one profile a document: its terms are the text's first words of
    eight plain letters or more (every 50th takes frequent ones), the rest follows from the id."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{8,}"), F.lit(0)).alias("w"))
    i, w = F.col("doc_id"), F.col("w")
    some = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    usual, salary = i % 5 == 0, i % 5 == 1
    weight = lambda only, other: F.when(usual, F.lit(None).cast("double")).when(salary, F.lit(only)).otherwise(F.lit(other))
    return d.select(
        i.cast("string").alias("profile"),
        F.when(i % 50 == 0, some("de", "la")).otherwise(F.slice(w, 1, 2)).alias("must_have"),
        F.when(i % 50 == 0, some("und", "tion")).otherwise(F.slice(w, 3, 2)).alias("nice_to_have"),
        F.slice(w, 5, 3).alias("keywords"), F.slice(w, 8, 1).alias("excluded"),
        F.when(i % 4 == 0, some("Remote")).otherwise(some("Nowhere")).alias("countries"),
        F.when(i % 8 == 1, some("remot")).otherwise(some()).alias("exclude_regions"),
        F.when(i % 3 == 0, some()).when(i % 3 == 1, some("startup")).otherwise(some("startup", "tech", "established")).alias("company_types"),
        (i % 2 == 0).alias("remote"), ((i % 7) * 1000).cast("double").alias("min_salary"),
        weight(0.0, 0.3).alias("skill_match_weight"), weight(0.0, 0.1).alias("location_weight"), weight(1.0, 0.2).alias("salary_weight"),
        weight(0.0, 0.1).alias("company_weight"), weight(0.0, 0.3).alias("job_description_weight"))


def order_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: sorted distinct words of its parts' names, and the names as text.

    lineitem -> part is an equi-join on the part key (Spark/AQE choose broadcast or
    shuffle from the measured size; part grows with the data, so no forced hint).
    The per-order group is bounded by the order's line count.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(part, li.l_partkey == part.p_partkey)
    # One list a group, nulls included: what needs the text only reads the same exchange as what needs the count.
    g = j.groupBy("l_orderkey").agg(F.collect_list(F.struct("p_name")).alias("l"))
    names, none = F.col("l.p_name"), F.array(F.lit(None).cast("string"))
    # nulls are not joined, so the text's words are those of the names
    return (g.select("l_orderkey", F.array_join(F.sort_array(names), " ").alias("part_text"), (F.size(F.array_except(names, none)) > 0).alias("_named"),
                     F.size("l").cast("bigint").alias("n_lines"))
            .select("l_orderkey",
                    F.when(F.col("_named"), F.sort_array(F.array_distinct(F.split(F.col("part_text"), " ")))).otherwise(F.array().cast("array<string>")).alias("skills"),
                    "part_text", "n_lines"))


def order_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings in the union-of-sources shape, one per order.

    status F -> LinkedIn shape, O -> Upwork shape, P -> neither (an indeed url).
    Every order is a posting; field shapes vary with the order priority so that
    every normalisation rule meets data.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    # nation (25 rows) and region (5 rows) are fixed-size by the TPC-H definition: safe to broadcast.
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    r = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    sk = order_skills(spark, sf_dir)
    base = (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == n.n_nationkey)
            .join(r, F.col("n_regionkey") == r.r_regionkey)
            .join(sk, o.o_orderkey == sk.l_orderkey, "left"))
    base = base.withColumn("_pr", F.substring(F.col("o_orderpriority"), 1, 1))
    st, pr = F.col("o_orderstatus"), F.col("_pr")
    li, up = st == "F", st == "O"
    key = F.col("o_orderkey").cast("string")
    a = F.floor(F.col("o_totalprice")).cast("bigint")
    b = F.floor(F.col("o_totalprice") * 1.2).cast("bigint")
    sal_text = (F.when(pr == "1", F.concat(F.lit("$"), a, F.lit(" - $"), b, F.lit(" per year")))
                .when(pr == "2", F.concat((a / 1000).cast("bigint"), F.lit("k-"), (b / 1000).cast("bigint"), F.lit("k")))
                .when(pr == "3", F.concat(F.lit("€"), a, F.lit(" to €"), b, F.lit(" hourly")))
                .when(pr == "4", F.concat(a, F.lit("-"), b, F.lit(" EUR")))
                .otherwise(F.concat(F.lit("Competitive pay, "), F.col("o_orderpriority"))))
    ts = F.col("o_orderdate")
    date_text = (F.when(pr == "1", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
                 .when(pr == "2", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")))
                 .when(pr == "3", F.date_format(ts, "yyyy-M-d"))
                 .when(pr == "4", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
                 .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))))
    hourly = F.floor(F.col("o_totalprice") / 1000).cast("double")
    company = F.concat(F.col("c_name"), F.lit(" "), F.initcap(F.col("c_mktsegment")))
    nul = F.lit(None)
    return base.select(
        key.alias("id"),
        F.col("o_orderkey").alias("input_seq"),
        F.concat(F.lit("Order "), F.col("o_orderpriority"), F.lit(" "), F.lower(F.col("c_mktsegment"))).alias("title"),
        F.coalesce(F.col("part_text"), F.lit("")).alias("description"),
        (F.when(li, F.concat(F.lit("https://www.linkedin.com/jobs/view/"), key))
         .when(up, F.concat(F.lit("https://www.upwork.com/jobs/~"), key))
         .otherwise(F.concat(F.lit("https://www.indeed.com/viewjob?jk="), key))).alias("url"),
        F.when(li, "linkedin").when(up, "upwork").otherwise("indeed").alias("source"),
        F.when(li, company).alias("organization"),
        F.when(up, company).alias("client_name"),
        F.when(~li & ~up, company).alias("company"),
        F.when(li, F.array(F.col("n_name"), F.col("r_name"))).alias("locations_derived"),
        F.when(up, F.col("n_name")).alias("client_country"),
        F.when(~li & ~up & (F.col("c_acctbal") > 8000), F.lit("Remote"))
         .when(~li & ~up, F.concat(F.col("r_name"), F.lit(", "), F.col("n_name"))).alias("location"),
        F.when(li & (pr != "5"), F.col("c_acctbal") > 5000).alias("remote_derived"),
        date_text.alias("date_posted"),
        F.when(li, sal_text).alias("salary_raw"),
        F.when(up & pr.isin("1", "2"), hourly).alias("project_budget_hourly_min"),
        F.when(up & (pr == "1"), hourly + 10).alias("project_budget_hourly_max"),
        F.when(up & pr.isin("3", "4"), F.floor(F.col("o_totalprice")).cast("double")).alias("project_budget_total"),
        F.when(up & (pr == "2"), "EUR").when(up & (pr == "4"), "GBP").alias("project_budget_currency"),
        F.when(up, F.col("skills")).alias("skills"),
        F.when(li, F.col("o_orderpriority")).alias("employment_type"),
        F.when(li, F.col("c_mktsegment")).alias("linkedin_org_size"),
        F.when(li, F.col("r_name")).alias("linkedin_org_industry"),
        F.when(li, F.concat(F.col("c_name"), F.lit("\tof\n"), F.col("n_name"))).alias("linkedin_org_description"),
        F.when(li, F.array(F.col("n_name"))).alias("cities_derived"),
        F.when(up & (pr != "5"), F.lower(F.col("o_orderpriority"))).alias("project_type"),
        F.when(up, F.round(F.col("c_acctbal") / 1000, 2)).alias("client_score"),
        F.when(up, F.col("n_lines")).alias("client_total_assignments"),
        F.when(up, F.concat(F.col("n_lines"), F.lit(" weeks"))).alias("engagement_duration_label"),
        F.when(up, F.concat(F.lit("up to "), F.col("n_lines") * 5, F.lit(" hrs/week"))).alias("weekly_hours"),
        F.when(up & (pr != "3"), F.col("c_mktsegment")).alias("category"),
        F.when(up & (pr != "3"), F.col("r_name")).alias("category_group"),
    )
