"""Matcher golden cases (FIXTURES.md section 4) with the shipped profile."""

from pyspark.sql import functions as F

from hirelens.config import SHIPPED_PROFILE
from hirelens.functions.text import match_text
from hirelens.operators import profile, scoring


def test_preference_vector():
    v = profile.preference_vector(SHIPPED_PROFILE)
    assert len(v) == 23
    norm = sum(x * x for x in v.values())
    assert abs(norm - 1.0) < 1e-12


def test_cosine_values(spark):
    texts = ["java spring backend remote", "java developer", "spring boot java backend developer", "python"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("c", match_text(F.col("t")))
    got = [round(r[0], 6) for r in scoring.text_cosine(df, F.col("c"), SHIPPED_PROFILE, "cos").select("cos").collect()]
    assert got == [0.661693, 0.328798, 0.588172, 0.0]


def test_skill_location_company(spark):
    df = spark.createDataFrame([
        (["javascript"], True, "Helsinki, Finland", "Acme Technologies Inc"),
        (["java", "spring", "rest api", "docker"], False, "Helsinki, Finland", "Acme"),
        ([], False, "Berlin", "Foo Labs"),
    ], "skills array<string>, remote boolean, location string, company string")
    rows = df.select(scoring.skill_score(F.col("skills"), SHIPPED_PROFILE).alias("s"),
                     scoring.location_score(F.col("location"), F.col("remote"), SHIPPED_PROFILE).alias("l"),
                     scoring.company_score(F.col("company"), SHIPPED_PROFILE).alias("c")).collect()
    assert [round(r.s, 6) for r in rows] == [round(0.7 / 3, 6), 0.775, 0.0]
    assert [r.l for r in rows] == [1.0, 0.8, 0.2]
    assert [round(r.c, 6) for r in rows] == [1.0, 0.5, round(0.5 + 0.5 / 3, 6)]


def test_histogram_last_bin_closed(spark):
    from hirelens.operators.report import score_histogram

    df = spark.createDataFrame([(i / 100.0,) for i in range(11)], "match_score double")
    got = [r.n_jobs for r in score_histogram(df).orderBy("bin").collect()]
    assert got == [1, 1, 1, 1, 1, 1, 1, 1, 1, 2]
