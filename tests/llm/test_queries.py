"""Registered queries against their SQL, and the pipeline against its stages."""

import os

import duckdb
import pytest

import corpus_pipeline
from hirelens.llm import catalog, decontam
from hirelens.llm.common import ready

SF = "/root/testdata/sf0.001"


def rows_of(items):
    return sorted(items, key=lambda t: [str(x) for x in t])


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ready(spark)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(catalog.ORACLE_SQL[name])
    own = [d[0] for d in res.description]
    assert sorted(own) == cols
    at = [own.index(c) for c in cols]
    assert rows_of(tuple(r[c] for c in cols) for r in df.collect()) == rows_of(tuple(r[i] for i in at) for r in res.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_covers_its_table(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    if name.startswith("op2"):
        docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
        items = {r.item_id: " ".join(decontam.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
        whole = {(d.doc_id, i) for d in docs for i, t in items.items() if f" {t} " in f" {' '.join(decontam.words_of(d.text))} "}
        assert whole and {(r.doc_id, r.item_id) for r in df.filter("edits = 0").collect()} == whole
    else:
        source = "pages" if name.startswith("op8") else "documents"
        assert df.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


def test_pipeline_drops_planted_cases(spark, tmp_path):
    """Copies, a leak and toxic documents go; clean documents stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert "ids" in out.columns
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    bench = [" ".join(decontam.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = set()
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        t = " ".join(decontam.words_of(r.text))
        if any(b in t for b in bench) or r.text in seen:
            assert r.doc_id not in ids
        seen.add(r.text)
    assert len(ids) > 0.6 * docs.count()
