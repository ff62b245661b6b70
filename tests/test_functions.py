"""Golden cases for the column rules (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from hirelens.functions import dates, salary, skills, text


def one(spark, values, fn, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("x")).alias("y")).collect()]


def test_salary_text(spark):
    cases = {
        "$80,000 - $100,000 per year": (80000.0, 100000.0, "$", "year"),
        "50k-60k": (50000.0, 60000.0, "USD", "year"),
        "50-60k": (50.0, 60.0, "USD", "year"),
        "3-5 years": (3.0, 5.0, "USD", "year"),
        "60000-70000 EUR": (60000.0, 70000.0, "USD", "year"),
        "45.50 - 60.25 per hour": (50.0, 60.0, "USD", "year"),
        "€40 to €50 hourly": (40.0, 50.0, "€", "hourly"),
        "10 t 12": (10.0, 12.0, "USD", "year"),
    }
    got = one(spark, list(cases), salary.parse_salary_text)
    for (k, exp), g in zip(cases.items(), got):
        assert (g["min"], g["max"], g["currency"], g["period"]) == exp, k
    bad = one(spark, ["50K-60K", "Java, to, go"], lambda c: salary.salary_parse_failed(salary.parse_salary_text(c)))
    assert bad == [True, True]
    assert one(spark, ["$50k to 60", None, ""], salary.parse_salary_text) == [None, None, None]


def test_salary_iso_first(spark):
    g = one(spark, ["60000-70000 EUR"], lambda c: salary.parse_salary_text(c, prefer_iso=True))[0]
    assert g["currency"] == "EUR"


def test_dates(spark):
    ok = ["2025-04-08T10:00:00.123", "2025-04-08 10:00:00+00:00", "2025-4-8", "2025-04-08T10:00:00.1+02:00"]
    nulls = ["2025-04-08T10:00:00", "2025-04-08T10:00:00Z", "2025-04-08T10:00:00-05:00", None, ""]
    got = one(spark, ok + nulls, dates.parse_posted_date)
    assert [str(g) for g in got[:4]] == ["2025-04-08"] * 4
    assert got[4:] == [None] * 5


def test_skill_words(spark):
    df = spark.createDataFrame([("c++ developer",), ("c++11",), ("c# and go",), ("node.js",), ("javascript",)], "x string")
    rows = df.select(*[F.col("x").rlike(text.word_regex(t)).alias(t) for t in ["c++", "c#", "node", "java", "go"]]).collect()
    assert rows[0]["c++"] is False and rows[1]["c++"] is True
    assert rows[2]["c#"] is False and rows[2]["go"] is True
    assert rows[3]["node"] is True and rows[4]["java"] is False


def test_clean_text(spark):
    got = one(spark, ["a\tb\nc  d​e", None, "  x   y  "], text.clean_text)
    assert got == ["abc de", "", "x y"]


def test_extract_skills(spark):
    df = spark.createDataFrame([(["Java", "AWS"], "We use Docker and java daily")], "s array<string>, d string")
    got = df.select(skills.extract_skills([F.col("s")], F.col("d")).alias("k")).first()["k"]
    assert got == ["aws", "docker", "java"]


def test_salary_tiers(spark):
    rows = [(0.0, 0.0, None), (90000.0, 0.0, "USD"), (72000.0, 0.0, None), (60000.0, 0.0, None),
            (48000.0, 0.0, None), (47999.0, 0.0, None), (0.0, 10.0, None), (55000.0, 0.0, "EUR"),
            (50000.0, 0.0, "GBP")]
    df = spark.createDataFrame(rows, "mn double, mx double, cur string")
    got = [r[0] for r in df.select(salary.salary_tier(F.col("mn"), F.col("mx"), F.col("cur"), 60000)).collect()]
    assert got == [0.5, 1.0, 0.9, 0.8, 0.6, 0.4, 0.5, 0.8, 0.8]


def test_word_rule_tries_its_classes_only_at_the_term(spark):
    """The literal stands first in the expression, and equals Python's rule wherever the term stands."""
    import random
    import re

    from hirelens.functions import skills, text

    rng = random.Random(4)
    terms = ["de", "c++", "++", ".net", "a b", "é", "𝒳", "_x", "aa"]
    texts = ["".join(rng.choice(["de", "c++", "+", ".net", "a", "b", " ", "é", "𝒳", "_", "x", "-", "\n"]) for _ in range(rng.randrange(0, 9))) for _ in range(400)]
    assert all(text.word_regex(t).startswith(re.escape(t)) for t in terms)
    df = spark.createDataFrame(list(enumerate(texts)) + [(900, None)], "i long, d string")
    sk = skills.extract_skills([], F.col("d"), terms)
    got = {r.i: r.s for r in df.select("i", sk.alias("s")).collect()}
    order = {i: sorted(t for t in terms if re.search(r"\b" + re.escape(t) + r"\b", x)) for i, x in enumerate(texts)}
    assert {i: sorted(v) for i, v in got.items()} == {**order, 900: []} and sum(map(len, got.values())) > 150
    plan = df.select(sk.alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1


def test_strip_runs_its_expression_only_at_white_ends(spark):
    spaces = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]
    assert sorted(text.SPACE_LIST) == spaces
    values = ["", "a", "a b", None, "\n", " \r\n", "a \r\n", "a\n \n", "\u200ba"] + [f"{s}a{s}b{s}{s}" for s in spaces] + [f"a{s}" for s in spaces] + [f"{s}𝒳" for s in spaces]
    assert one(spark, values, text.py_strip) == [v if v is None else v.strip() for v in values]
    plan = spark.createDataFrame([("a",)], "x string").select(text.py_strip("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and plan.index("CASE WHEN") < plan.index("regexp_replace(")
