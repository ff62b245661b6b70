"""P8 with a dictionary table against the rule per term."""

import random
import re

from pyspark.sql import functions as F

from hirelens.functions import skills
from hirelens.operators import dictionary


def written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_equals_the_rule_for_awkward_terms(spark, tmp_path):
    rng = random.Random(7)
    marks = [" ", "  ", "+", "#", ".", "-", "\n", "_", "/", "é", "𝒳", "$", "\\", ""]
    word = lambda: rng.choice(["java", "c", "go", "ai", "data", "net", "é", "x1", "script"])
    say = lambda k: "".join(word() + rng.choice(marks) for _ in range(k))
    texts = [(i, say(rng.randrange(0, 40))) for i in range(250)] + [(900, None), (901, ""), (902, "c++11 c++ .net x.net c# c#x ++ a++b")]
    terms = list({say(rng.randrange(1, 4)) for _ in range(150)}) + ["c++", "c#", ".net", "++", "+", "", None, "java", "java", "data science", "$", "\\"] + skills.TECH_SKILLS
    t = written(spark.createDataFrame(texts, "id long, text string"), tmp_path / "t")
    got = {(r.id, r.term) for r in dictionary.dictionary_matches(t, spark.createDataFrame([(x,) for x in terms], "term string")).collect()}
    want = {(i, x) for i, s in texts if s for x in set(terms) if x and re.search(r"\b" + re.escape(x) + r"\b", s)}
    assert got == want and len(want) > 300


def test_equals_the_thirty_terms_and_takes_a_hundred_thousand(spark, tmp_path):
    df = spark.createDataFrame([(i, f"We use Python, {t} and machine learning{x} on AWS.", ["Own", "SQL"]) for i, (t, x) in enumerate(
        (t, x) for t in [*skills.TECH_SKILLS, "c++11", "javascripts", "none"] for x in ("", "s"))] + [(900, None, None)], "input_seq long, description string, tags array<string>")
    small = spark.createDataFrame([(t,) for t in skills.TECH_SKILLS], "term string")
    want = {r.input_seq: r.skills for r in df.withColumn("skills", skills.extract_skills([F.col("tags")], F.col("description"))).collect()}
    out = dictionary.extract_skills_table(df, small, [F.col("tags")])
    assert {r.input_seq: r.skills for r in out.collect()} == want
    large = small.unionByName(spark.range(100_000).select(F.concat(F.lit("term"), F.col("id"), F.when(F.col("id") % 3 == 0, " of art").otherwise("")).alias("term")))
    more = df.unionByName(spark.createDataFrame([(950, "term3 of art, term4, term5x", None)], df.schema))
    big = dictionary.extract_skills_table(more, large, [F.col("tags")])
    assert {r.input_seq: r.skills for r in big.collect()} == {**want, 950: ["term3 of art", "term4"]}
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert size(big) < 1.2 * size(out)


def test_only_long_terms_need_an_expression(spark, tmp_path):
    """Phrases of two words and terms that end in marks are decided by the join: no text is joined back for them."""
    texts = written(spark.createDataFrame([(1, "one two, three"), (2, "one  two"), (3, "a.b (c) x"), (4, ".b one two")], "id long, text string"), tmp_path / "t")
    terms = [("one two",), ("two, three",), ("a.",), (".b",), (".",), (" (c",), ("b (c) x",)]
    root = str(tmp_path / "s")
    got = {(r.id, r.term) for r in dictionary.dictionary_matches(texts, spark.createDataFrame(terms, "term string"), root).collect()}
    assert got == {(1, "one two"), (1, "two, three"), (3, "a."), (3, ".b"), (3, "."), (3, " (c"), (3, "b (c) x"), (4, "one two")}
    assert {r.term for r in spark.read.parquet(f"{root}/met").filter("not single").collect()} == {"b (c) x"}
