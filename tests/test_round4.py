"""Round 4: work that is done once, compiled or on fewer columns, with the same rows."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from hirelens.functions import skills, text
from hirelens.operators import dedup, load, load_batches, rank, scoring
from hirelens.operators.normalize import once
from hirelens.plans import catalog
from hirelens.sources import postings
from hirelens.sources.tables import order_skills
from hirelens.streaming import ingest

SCORED = ("input_seq long, id string, title string, description string, source string, url string, location string, city string, company string, job_type string, "
          "employment_type string, posted_date date, salary struct<min:double,max:double,currency:string,period:string>, skills array<string>, remote boolean, "
          "client_jobs_posted long, client_rating double, engagement_duration string, weekly_hours string, category string, category_group string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def scored_rows(spark, calls):
    """Twenty scored orders, each evaluation of a row counted."""
    row = lambda i: (i, f"k{i}", f"Title {i}", "text, with \"quotes\"\nand lines", "upwork", "u", "here", None, "c", None, None, None, (1.0, 2.0, "USD", "year"), ["a"],
                     True, None, None, None, None, None, None)

    def seen(x):
        calls.add(1)
        return x
    df = spark.createDataFrame([row(i) for i in range(20)], SCORED).withColumn("match_score", F.udf(seen, "double")((F.col("input_seq") % 7 / 7).cast("double")))
    return df.withColumns({c: F.lit(0.25) for c in scoring.SCORES if c != "match_score"})


def test_two_loads_score_once(spark, monkeypatch):
    calls = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(catalog, "order_scored", lambda *a: scored_rows(spark, calls))
    rows = catalog.q_s9_second_load(spark, "").collect()
    assert calls.value == 20 and sorted(r.id for r in rows) == list(range(1, 21))
    assert {r.external_id for r in rows if r.id <= 10} == {f"k{i}" for i in range(0, 20, 2)}


def test_load_rejects_scores_once_and_packs_its_export(spark, monkeypatch, tmp_path):
    calls, dropped = spark.sparkContext.accumulator(0), []
    monkeypatch.setattr(catalog, "order_scored", lambda *a: scored_rows(spark, calls))
    monkeypatch.setattr(catalog, "_scratch", lambda s, name: str(tmp_path / name))
    rows = {r.input_seq: r for r in catalog.q_s9_load_rejects(spark, "").collect()}
    assert calls.value == 20 and len(rows) == 20 and not (tmp_path / "scored").exists()
    assert rows[0].status == "match_score: not a number" and rows[13].status == "salary_score: out of range" and rows[17].status == "posted_date: not a date"
    assert all(r.exact for r in rows.values() if r.status == "loaded")
    files = list((tmp_path / "text-export").glob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)


def test_wide_ranking_reads_what_is_asked(spark):
    df = spark.range(0, 300, 1, 5).select(F.col("id").alias("input_seq"), (F.col("id") % 7).cast("double").alias("match_score"), F.repeat(F.lit("x"), 50).alias("description"))
    df = df.unionByName(df.limit(3))  # rows and ids may repeat
    both = [rank.with_dense_rank(df, rank.ranking_order(), wide=w) for w in (False, True)]
    assert both[0].columns == both[1].columns
    kept = [sorted((r["rank"], r.input_seq, r.match_score) for r in b.collect()) for b in both]
    assert kept[0] == kept[1] and len(kept[0]) == 303
    narrow = both[1].select("rank", "input_seq")._jdf.queryExecution().executedPlan().toString()
    assert "description" not in narrow.split("Initial Plan")[-1].split("Location")[0]


def test_staged_rows_are_numbered_by_rank(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    path, n, _ = load_batches.stage(scored_rows(spark, calls), str(tmp_path), "b", "2025-01-01")
    got = spark.read.parquet(path).orderBy("number").collect()
    assert n == 20 and [r.number for r in got] == list(range(20)) and [r.input_seq for r in got] == sorted(range(20), key=lambda i: (-(i % 7), i))
    assert "_row" not in got[0].asDict()


def test_shared_columns_are_compiled(spark):
    df = once(spark.range(3), a=F.transform(F.array("id"), lambda x: x + 1), b=F.upper(F.col("id").cast("string")))
    node = [line for line in plan(df).split("\n") if "Generate" in line]
    assert len(node) == 1 and "upper" not in node[0] and [(r.a, r.b) for r in df.orderBy("id").collect()] == [([1], "0"), ([2], "1"), ([3], "2")]


def test_skills_keep_a_null_last_without_interpreted_sort(spark):
    df = spark.createDataFrame([(["B", None, "a", "B", None], "go java"), (None, None), ([], "java")], "s array<string>, d string")
    terms = ["java", "go", "go"]
    out = once(df, i=skills.skill_items([F.col("s")], F.lower(F.coalesce("d", F.lit(""))), terms)).select(skills.sorted_items(F.col("i")).alias("l"),
                                                                                                       skills.extract_skills([F.col("s")], F.col("d"), terms).alias("k"))
    want = [["a", "b", "go", "java", None], [], ["java"]]
    rows = out.collect()
    assert [r.k for r in rows] == want and [r.l for r in rows] == want and "array_sort" not in plan(out.select("l"))


def test_text_rules_on_plain_and_other_characters(spark):
    df = spark.createDataFrame([("a\tb\nc  d   e ",), ("\u00e9\u00a0x\u200b\U0001F600 -_",), ("Plain text",), (None,)], "x string")
    got = [tuple(r) for r in df.select(text.clean_text("x"), text.match_text(F.col("x"))).collect()]
    assert got == [("abc d e", "a\tb\nc  d   e "), ("\u00e9x\U0001F600 -_", "\u00e9\u00a0x    _"), ("Plain text", "plain text"), ("", "")]


def test_cosine_counts_repeats_and_pairs(spark):
    profile = {"skills": {"must_have": ["spring"], "nice_to_have": ["boot"]}, "keywords": ["java"]}
    df = spark.createDataFrame([("spring boot the spring",), ("nothing here",), ("",)], "x string")
    out = scoring.text_cosine(df, F.col("x"), profile, "c")
    # spring twice, boot, "spring boot" and (the stop word left out) "boot spring", which the profile lacks; weights 1/sqrt(5)
    assert [round(r.c, 9) for r in out.collect()] == [round((2 + 1 + 1) / 5 ** 0.5 / 6 ** 0.5, 9), 0.0, 0.0] and out.columns == ["x", "c"]


def test_order_words_share_one_list(spark, tmp_path):
    spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 2, 3), (2, 3, 1), (3, 4, 1)], "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "red ring"), (2, "blue ring"), (3, None), (4, "")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    sk = order_skills(spark, str(tmp_path))
    got = {r.l_orderkey: (r.skills, r.part_text, r.n_lines) for r in sk.collect()}
    assert got == {1: (["blue", "red", "ring"], "blue ring blue ring red ring", 3), 2: ([], "", 1), 3: ([""], "", 1)}
    assert sk.columns == ["l_orderkey", "skills", "part_text", "n_lines"] and sk.schema["n_lines"].dataType.typeName() == "long"
    both = sk.join(sk.select("l_orderkey", F.col("part_text").alias("t")), "l_orderkey")
    both.collect()
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([('{"input_seq": 1, "title": "t"}',), ("{broken",), ('{"title": "no number"}',), (None,)], "value string")
    raw = postings.lines_to_raw(lines)
    assert plan(raw).count("parse_json(") + plan(raw).count("parseJson") <= 1 and [(r.input_seq, r.title) for r in raw.collect()] == [(1, "t")]


def test_stream_shuffles_the_columns_that_are_read(spark, tmp_path):
    lines = ['{"input_seq": %d, "title": "t%d", "url": "u", "collected_at": "2025-01-0%dT00:00:00Z"}' % (i, i % 3, 1 + i) for i in range(6)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "in"))
    seen, got = [], {}

    def clean(batch):
        seen.append(set(batch.columns))
        return batch.select("input_seq", "title")
    for name, columns in (("all", None), ("few", ["input_seq", "title"])):
        ingest.run_available(spark, str(tmp_path / "in"), str(tmp_path / name), str(tmp_path / f"{name}-state"), clean, columns=columns)
        got[name] = [r.title for r in spark.read.schema("input_seq long, title string, batch int").parquet(str(tmp_path / name)).collect()]
    assert sorted(got["all"]) == sorted(got["few"]) == ["t0", "t1", "t2"]
    assert seen[-1] == {"input_seq", "title", "event_time"} and "record_text" in seen[0]


def test_ratio_equals_difflib():
    rnd = random.Random(5)
    for i in range(300):
        letters = ["ab", "abcdefghij", "abcdefghijklmnopqrstuvwxyzéü0123456789", "abcd" * 20 + "".join(map(chr, range(300, 400)))][i % 4]
        a, b = ("".join(rnd.choices(letters, k=rnd.randint(0, 500))) for _ in range(2))
        if i % 3:
            cut = rnd.randint(0, len(a))
            b = a[:cut] + b[:rnd.randint(0, 40)] + a[cut + rnd.randint(0, 9):]
        assert dedup._ratio(a, b) == SequenceMatcher(None, a, b).ratio()
        bound = dedup.ratio_bound(a, b)
        assert bound >= dedup._ratio(a, b) - 1e-12
        assert dedup.ratio_bound(a, b, 0.0, dedup.char_masks(a)) == dedup.ratio_bound(b, a, 0.0, dedup.char_masks(b)) == bound


def test_copies_are_compared_once_a_block(monkeypatch):
    import pandas as pd

    texts = [("one line", "x" * 90 + "abcdefghij"), ("one line", "x" * 90 + "abcdefghik"), ("One line", "X" * 90 + "abcdefghij")]
    rows = [(10 * i + k, *texts[k]) for i in range(5) for k in range(3)]
    side = {"bt": 0, "bd": 0, "seq": [r[0] for r in rows], "lt": [8] * 15, "ld": [100] * 15, "twice": [False] * 15, "title": [r[1] for r in rows], "description": [r[2] for r in rows],
            "bag": [b"".join(dedup._counts(x).tobytes() for x in r[1:]) for r in rows]}
    block = pd.DataFrame([{**{f"a_{k}": v for k, v in side.items()}, **{f"b_{k}": v for k, v in side.items()}, "a_i": 0, "b_i": 0}])
    calls, real = [], dedup.similarity_above
    monkeypatch.setattr(dedup, "similarity_above", lambda *x: calls.append(1) or real(*x))
    out = pd.concat(list(dedup._block_edges(0.9)([block])))
    want = {(a[0], b[0]): real(a[1].lower(), b[1].lower(), a[2].lower(), b[2].lower(), 0.9) for a in rows for b in rows if a[0] > b[0]}
    assert {(r.l_seq, r.e_seq): r.similarity for r in out.itertuples()} == {k: v for k, v in want.items() if v is not None} and len(out) == 105
    # two different texts, in either order
    assert len(calls) <= 4


def test_long_near_copies_take_no_minutes():
    import time

    rnd = random.Random(1)
    a = "".join(rnd.choices("abcdefghijklmnop", k=40_000))
    b = "".join(c if rnd.random() > 0.01 else "q" for c in a)
    start = time.process_time()
    dedup.similarity_above("t", "t", a, b, 0.9)
    assert time.process_time() - start < 20
