"""Nulls in any column, empty and very long texts, repeated rows, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelens.llm import decontam, lines, maxent, minhash, nndescent, pieces, sharding, toxicity, urls
from hirelens.llm.common import fold_of

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, shard int, band long, cls string, "
          "ids string, line string, pos int, n int, comp long, held_out string, kept string, Doc string, m string, leaf string")
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def rows():
    def row(i, t, source="s"):
        return (i, t, "en", source, None if t is None else len(t), 1.0, 2, 3, "c", "i", "l", 4, 5, 6, "h", "k", "d", "m", "f")
    some = "the quick brown fox jumps over the lazy dog and runs away\nsecond line with several more words in it"
    return [row(1, some), row(1, some), row(2, None), row(3, ""), row(4, LONG), row(5, LONG + " more"), row(None, some), row(None, None),
            row(6, "   \n\t\n "), row(7, "short"), row(8, some.upper(), None), row(9, " ​ \U0001f600"),
            (10,) + (None,) * 18]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A data folder with awkward labels and benchmark items."""
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, 1, 0), (3, None, None), (None, 1, 1), (7, 0, 1), (7, 0, 0), (99, 1, 1), (5, 1, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (None, "word1 word2 word3 word4 word5 word6 word7"), (3, "short"), (3, "short"), (4, "!!")],
                          "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


OPERATORS = {
    "toxicity": lambda spark, d, sf: toxicity.with_score(d, toxicity.fit(d, spark.read.parquet(f"{sf}/labels.parquet"))),
    "lines": lambda spark, d, sf: lines.drop_recurring(d),
    "minhash": lambda spark, d, sf: minhash.near_duplicates(d),
    "maxent": lambda spark, d, sf: maxent.score(d, fold_of("doc_id", 5) == 1),
    "pieces": lambda spark, d, sf: pieces.digests(d),
    "sharding": lambda spark, d, sf: sharding.shards(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_every_row_has_a_result(spark, docs, sf, name):
    out = OPERATORS[name](spark, docs, sf).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows())


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(spark, docs, empty, name):
    assert OPERATORS[name](spark, docs.limit(0), empty).count() == 0


def test_results_are_as_documented(spark, docs, sf):
    near = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert near[1, 16] == (1, True) and near[8, 16] == (1, False) and near[None, 16] == (1, False)
    assert near[2, 0] == (2, True) and near[3, 0] == (3, True) and near[None, 0] == (None, True) and near[6, 0] == (6, True)
    assert near[4, 977] == (4, True) and [v for (d, _), v in near.items() if d == 5] == [(4, False)]
    found = {(r.doc_id, r.item_id) for r in decontam.matches(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert found == {(4, None), (5, None), (7, 3)}
    shard = sharding.shards(docs).collect()
    assert [(r.size, r.text_crc32) for r in shard if r.doc_id == 2] == [(1, None)]
    lm = {r.doc_id: r for r in maxent.score(docs, F.col("doc_id") == 7).collect()}
    assert lm[3].n_tokens == lm[2].n_tokens == 1 and lm[7].held_out and lm[7].n_known == 1


@pytest.mark.parametrize("stage", [0, 1, 2, 3, 4])
def test_pipeline_stage(spark, docs, sf, empty, stage):
    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, docs, sf)
    if stage < 4:
        assert out.columns == docs.columns
    kept = sorted(str(r.doc_id) for r in out.collect())
    everyone = sorted(str(r[0]) for r in rows())
    if name in ("line_dedup", "sentencepiece"):
        assert kept == everyone
    if name == "minhash_near_dedup":
        assert kept == sorted(["1", "2", "3", "4", "6", "7", "9", "10", "None"])
    if name == "decontamination":
        assert kept == sorted(x for x in everyone if x not in "457")
    assert f(spark, docs.limit(0), empty).count() == 0


def test_urls_edges(spark):
    pages = spark.createDataFrame([(None, "http://x.com/de/1", "h"), (1, None, None), (1, None, "v"), (2, "http://" + "a." * 2000 + "org/" + "p/" * 5000, "h")],
                                  "page_id long, url string, host string")
    got = sorted((str(r.page_id), r.verdict) for r in urls.filter_urls(pages).collect())
    assert got == [("1", "allow"), ("1", "allow"), ("2", "allow"), ("None", "block")]
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_embeddings_edges(spark):
    rows_ = [(None, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (3, None, None, None)]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<float>, label int, node string")
    got = sorted((str(r.vec_id), r.n_links, r.component_id) for r in nndescent.near_duplicates(df).collect())
    assert got == [("1", 3, 1), ("1", 3, 1), ("2", 3, 1), ("3", 0, 3), ("None", 3, 1)]
    assert nndescent.near_duplicates(df.limit(0)).count() == 0


def test_token_count_query_on_awkward_rows(spark, docs, tmp_path):
    """op3 over nulls, empty, very long and repeated texts, clashing names, and an empty table, as its SQL says."""
    import duckdb

    from hirelens.llm import token_counts

    for name, df in (("some", docs), ("none", docs.limit(0))):
        root = str(tmp_path / name)
        df.coalesce(1).write.parquet(f"{root}/documents.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{root}/documents.parquet/*.parquet'")
        want = con.execute(token_counts.ORACLE)
        names = [c[0] for c in want.description]
        want = sorted(map(str, want.fetchall()))
        got = token_counts.op3(spark, root)
        assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want
        assert (len(want) == 0) == (name == "none")


def test_matches_on_an_empty_table(spark, docs, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontam.matches(docs.limit(0), bench).count() == 0 and decontam.matches(docs, bench.limit(0)).count() == 0
