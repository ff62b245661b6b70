"""D1-D3 against an independent plain-Python greedy loop (the reference rule)."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from hirelens.operators import dedup
from hirelens.sources.tables import doc_postings

SF = "/root/testdata/sf0.001"


def sim(a, b):
    t = SequenceMatcher(None, str(a[0]).lower(), str(b[0]).lower()).ratio()
    d = SequenceMatcher(None, str(a[1]).lower(), str(b[1]).lower()).ratio()
    return (t + d) / 2


def greedy(rows, thr=0.9):
    kept = []
    for seq, t, d in rows:
        if not any(sim((t, d), (kt, kd)) > thr for _, kt, kd in kept):
            kept.append((seq, t, d))
    return [k[0] for k in kept]


def test_similarity_values(spark):
    df = spark.createDataFrame([("", "", "", ""), ("software engineer", "software engineer ii", "", ""),
                                ("backend java developer", "frontend java developer", "x", "")],
                               "a string, b string, c string, d string")
    got = [round(r[0], 6) for r in df.select(dedup.pair_similarity("a", "b", "c", "d")).collect()]
    assert round(SequenceMatcher(None, "software engineer", "software engineer ii").ratio(), 6) == 0.918919
    assert round(SequenceMatcher(None, "backend java developer", "frontend java developer").ratio(), 6) == 0.8
    assert got == [1.0, round((SequenceMatcher(None, "software engineer", "software engineer ii").ratio() + 1) / 2, 6), 0.4]


def test_order_dependence(spark):
    a, b, c = ("alpha beta gamma delta", "x" * 40), ("alpha beta gamma delts", "x" * 40), ("alpha beta gamma dflts", "x" * 40)
    assert sim(b, a) > 0.9 and sim(c, b) > 0.9
    rows = [(1, *a), (2, *b), (3, *c)]
    df = spark.createDataFrame(rows, "input_seq bigint, title string, description string")
    got = sorted(r[0] for r in dedup.dedup_near(df).select("input_seq").collect())
    assert got == greedy(rows)


def test_dedup_near_matches_python_loop(spark):
    # The plain-Python oracle is quadratic in pairs x text length: keep its fixture to shorter texts.
    p = doc_postings(spark, SF).filter(F.col("source").isin("linkedin", "upwork", "indeed") & (F.length("description") < 1500))
    rows = sorted((r.input_seq, r.title, r.description) for r in p.select("input_seq", "title", "description").collect())
    expect = greedy(rows)
    got = sorted(r[0] for r in dedup.dedup_near(p).select("input_seq").collect())
    assert got == expect
    assert len(got) < len(rows)


@pytest.mark.parametrize("thr", [0.4, 0.7, 0.85, 0.9, 0.95])
def test_dedup_near_at_any_threshold(spark, thr):
    rng = random.Random(7)
    rows = []
    for i in range(160):
        base = rows[rng.randrange(i)] if i and rng.random() < 0.6 else None
        t, d = (base[1], base[2]) if base else ("".join(rng.choices("abcde fgh", k=rng.randint(0, 40))),
                                                "".join(rng.choices("klmno pqrs", k=rng.choice([0, 3, 30, 250]))))
        t = "".join(c for c in t if rng.random() > 0.1) + "x" * rng.randint(0, 6)
        d = "".join(c for c in d if rng.random() > 0.08) + "yz" * rng.randint(0, 8)
        rows.append((i, t, d))
    # a long text: difflib's popular-character rule (autojunk) starts at 200 characters
    rows += [(200, "long text", "abc def " * 300), (201, "long texts", "abc def " * 290 + "zz"), (202, None, None), (203, "", "")]
    df = spark.createDataFrame(rows, "input_seq bigint, title string, description string")
    got = sorted(r[0] for r in dedup.dedup_near(df, thr, block_rows=16).select("input_seq").collect())
    assert got == greedy([(i, t or "", d or "") for i, t, d in rows], thr)


def test_dedup_exact_keeps_first(spark):
    df = spark.createDataFrame([(3, "A ", "x", "u"), (1, "a", "x", "u"), (2, "b", "x", "u")],
                               "input_seq bigint, title string, description string, url string")
    assert sorted(r[0] for r in dedup.dedup_exact(df).select("input_seq").collect()) == [1, 2]


def test_lsh_candidates_find_close_copies(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        t, d = "".join(rng.choices("abcdefghij ", k=30)), "".join(rng.choices("klmnopqrstu ", k=150))
        rows += [(2 * i, t, d), (2 * i + 1, t, d[:70] + "zz" + d[70:])]
    df = spark.createDataFrame(rows, "input_seq bigint, title string, description string")
    got = sorted(r[0] for r in dedup.dedup_near(df, candidates="lsh").select("input_seq").collect())
    assert got == greedy(rows) == list(range(0, 120, 2))


def test_common_subsequence_bounds_the_ratio():
    import random
    from difflib import SequenceMatcher

    from hirelens.operators.dedup import ratio_bound

    rng = random.Random(12)

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
        return row[-1]
    for k in range(120):
        a = "".join(rng.choice("abcdé 𝒳") for _ in range(rng.randrange(0, 90)))
        b = a if k % 5 == 0 else "".join(rng.choice("abcdé 𝒳") if rng.random() < 0.3 else c for c in a) + a[: rng.randrange(1, 30)]
        total = len(a) + len(b)
        assert ratio_bound(a, b) == (2.0 * lcs(a, b) / total if total else 1.0) >= SequenceMatcher(None, a, b).ratio()
    long = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(2)]
    exact = ratio_bound(*long)
    assert exact <= ratio_bound(*long, 0.9) <= 0.9 and ratio_bound(*long, 0.1) == exact >= SequenceMatcher(None, *long).ratio()
    assert ratio_bound("", "") == 1.0 and ratio_bound("", "a") == 0.0


def test_written_bytes_grow_with_rows_not_with_pairs(spark, tmp_path, monkeypatch):
    """Rows of one length cell in many blocks: each is written once, however many blocks it meets."""
    rng = random.Random(3)
    rows = [(i, "Same title", "".join(rng.choices("abcdefgh ", k=300))) for i in range(240)]
    df = spark.createDataFrame(rows, "input_seq bigint, title string, description string")
    monkeypatch.setattr(dedup, "scratch_path", lambda s, name: str(tmp_path / "scratch"))
    edges = dedup.similar_edges(df, 0.9, block_rows=4)
    assert edges.count() == 0
    blocks = spark.read.parquet(str(tmp_path / "scratch" / "blocks"))
    assert blocks.count() > 40 and blocks.select(F.sum(F.size("seq"))).first()[0] == 240
    assert "FlatMapGroupsInPandas" not in edges._jdf.queryExecution().executedPlan().toString()
