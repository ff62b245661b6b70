"""Shared steps that must not compute their input again: scores under a filter, signatures, histogram, ranking, D2."""

from pyspark.sql import functions as F

from hirelens.functions import dates, salary
from hirelens.operators import dedup, rank, report, scoring
from hirelens.plans import catalog

PROFILE = {"skills": {"must_have": ["java"], "nice_to_have": []}, "keywords": ["java", "spring"], "excluded_terms": ["php"], "min_salary": 10,
           "company_types": ["tech"], "locations": {"remote": True, "countries": ["x"], "exclude_regions": []}}
POSTING = ("input_seq long, title string, description string, skills array<string>, location string, remote boolean, company string, "
           "salary struct<min:double,max:double,currency:string,period:string>")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_filter_on_a_score_repeats_no_text_rule(spark):
    rows = [(i, "Java developer", "java spring " * i, ["java"], "x", True, "tech", (20.0, 30.0, "USD", "year")) for i in range(5)]
    scored = scoring.score(spark.createDataFrame(rows, POSTING), PROFILE)
    out = rank.notification_set(scored, 0.1, 3).select("input_seq", "match_score")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1
    assert [r.input_seq for r in out.collect()] == [r.input_seq for r in scored.orderBy(F.desc("match_score"), "input_seq").limit(3).collect()]
    again = scoring.score(scored, PROFILE)  # earlier scores are replaced
    assert again.columns == scored.columns and sorted(again.collect()) == sorted(scored.collect())


def test_signatures_are_computed_once(spark):
    df = spark.range(40).select(F.col("id").alias("input_seq"), (F.col("id") % 30).cast("string").alias("title"), F.lit("d").alias("description"), F.lit(None).cast("string").alias("url"))
    out = dedup.dedup_exact(df.unionByName(df.limit(2).withColumn("input_seq", F.lit(None).cast("long"))))
    assert "ReusedExchange" in final_plan(out)
    assert sorted(r.input_seq for r in out.filter("input_seq is not null").collect()) == list(range(30)) and out.filter("input_seq is null").count() == 2


def test_histogram_computes_scores_once(spark):
    out = report.score_histogram(spark.createDataFrame([(i / 10,) for i in range(10)] + [(None,)], "match_score double"))
    assert "ReusedExchange" in final_plan(out) and sum(r.n_jobs for r in out.collect()) == 11
    assert report.score_histogram(spark.createDataFrame([], "match_score double")).count() == 0


def test_ranking_computes_rows_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(x):
        calls.add(1)
        return x
    df = spark.range(0, 500, 1, 4).select(F.udf(seen, "long")("id").alias("input_seq")).withColumn("match_score", (F.col("input_seq") % 7).cast("double"))
    got = [(r["rank"], r.input_seq) for r in rank.with_dense_rank(df, rank.ranking_order()).orderBy("rank").collect()]
    assert calls.value == 500
    assert got == [(i + 1, s) for i, s in enumerate(sorted(range(500), key=lambda s: (-(s % 7), s)))]


def test_edges_bring_their_similarity(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(300))
    df = spark.createDataFrame([(1, "Same", text), (2, "same", text + "x"), (3, "Same", text), (4, "other", "q" * 50)], "input_seq long, title string, description string")
    got = {(r.l_seq, r.e_seq): r.similarity for r in dedup.similar_edges(df).collect()}
    a, b = df.alias("a"), df.alias("b")
    want = {(r[0], r[1]): r[2] for r in a.join(b, F.col("a.input_seq") > F.col("b.input_seq"))
            .select("a.input_seq", "b.input_seq", dedup.pair_similarity("a.title", "b.title", "a.description", "b.description")).collect()}
    assert got == {k: v for k, v in want.items() if v > 0.9} and len(got) == 3
    plan = dedup.similar_edges(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("similar(") == 1


def test_repeated_ids_pair_every_row(spark, tmp_path):
    text = "A first line of a text\n" + "".join(chr(97 + i * i % 23) for i in range(300))
    rows = [(1, text), (1, text), (2, text + "x"), (5, text + "yy")]
    spark.createDataFrame([(i, x, "en") for i, x in rows], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.l_seq, r.e_seq) for r in catalog.q_d2_pair_similarity(spark, str(tmp_path)).collect())
    # a candidate for each of the two rows, each joined with both rows twice
    assert got == [(2, 1)] * 8 + [(5, 1)] * 8 + [(5, 2)]


def test_guards_lose_no_date_and_no_salary(spark):
    days = ["2024-1-5", "2024-1-5T1:2:3.5", "2024-1-5t1:2:3.123456", "2024-01-05 10:11:12+00:00", "2024-01-05T10:11:12", "2024-01-05 ", "", None]
    d = spark.createDataFrame([(x,) for x in days], "x string").select(dates.parse_posted_date("x").cast("string").alias("d"))
    assert [r.d for r in d.collect()] == ["2024-01-05"] * 4 + [None] * 4
    texts = ["50k-60K", "$1,000 to €2,000 per year", "5 – 6 GBP", "5 6", "a-b", "1 - 2", None]
    s = spark.createDataFrame([(x,) for x in texts], "x string").select(salary.parse_salary_text("x").isNotNull().alias("s"))
    assert [r.s for r in s.collect()] == [True, True, True, False, False, True, False]
