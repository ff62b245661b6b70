"""Loads that interleave, die and are run again; the exact percent text."""

import random

import pytest
from pyspark.sql import functions as F

from hirelens.functions import fmt
from hirelens.operators import load_batches
from hirelens.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scored") / "s")
    catalog.order_scored(spark, SF).filter("input_seq < 400").write.parquet(path)
    return spark.read.parquet(path)


def state(spark, root):
    rows = load_batches.loaded(spark, root).collect()
    keys = [(r.source, r.external_id) for r in rows]
    assert len(set(keys)) == len(keys) and len({r.id for r in rows}) == len(rows)
    return {r.external_id: (r.batch, r.id) for r in rows}


def test_interleaved_loads_and_replays(spark, scored, tmp_path):
    root = str(tmp_path / "r")
    half, all_ = scored.filter("input_seq % 2 = 0"), scored
    n, m = half.count(), all_.count()
    a = load_batches.stage(half, root, "a", "2025-01-01")
    b = load_batches.stage(all_, root, "b", "2025-01-01")
    eb = load_batches.reserve(spark, root, "b", *b)
    ea = load_batches.reserve(spark, root, "a", *a)
    assert (eb["first_id"], ea["first_id"]) == (1, m + 1)
    assert load_batches.commit(spark, root, ea) == 0  # b has them all, though it is not written yet
    assert load_batches.commit(spark, root, eb) == m
    first = state(spark, root)
    assert set(first.values()) == {("b", i) for i in range(1, m + 1)}
    for name, df in (("a", half), ("b", all_), ("c", all_)):
        assert load_batches.load_batch(df, root, name, "2025-01-02") == 0
    assert state(spark, root) == first and [r["batch"] for r in load_batches.reservations(spark, root)] == ["b", "a", "c"]
    assert n < m


def test_a_load_that_dies_goes_on(spark, scored, tmp_path):
    root = str(tmp_path / "r")
    assert load_batches.loaded(spark, root) is None
    load_batches.stage(scored, root, "x", "2025-01-01")  # died before its reservation: nothing is taken
    staged = load_batches.stage(scored.filter("input_seq < 100"), root, "y", "2025-01-01")
    load_batches.reserve(spark, root, "y", *staged)      # died before it was written: its rows are its own
    total = load_batches.load_batch(scored, root, "z", "2025-01-01")
    assert total == scored.filter("input_seq >= 100").count()
    assert load_batches.load_batch(scored.filter("input_seq < 100"), root, "y", "2025-01-01") == staged[1]
    got = state(spark, root)
    assert len(got) == scored.count() and {got[k][0] for k in got} == {"y", "z"}
    doubled = scored.unionByName(scored.withColumn("input_seq", F.col("input_seq") + 10_000))
    assert load_batches.load_batch(doubled, str(tmp_path / "other"), "d", "2025-01-01") == scored.count()  # one row a key
    with pytest.raises(ValueError):
        load_batches.load_batch(scored, root, "../z", "2025-01-01")


def test_percent_text_is_that_of_the_exact_value(spark):
    rng = random.Random(3)
    xs = [0.25, 0.35, 0.1225, 0.1235, 0.0005, 0.00049999, 0.9995, 0.99949, 1.0, 0.0, 0.125, 0.375, 0.8125, 0.00125, 0.00375, -0.1225, 1e-300, 5e-324, 123.4565]
    xs += [rng.random() for _ in range(3000)] + [rng.randrange(100_000) / 100_000 for _ in range(3000)] + [rng.randrange(8000) / 8000 for _ in range(3000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)] + [(-1, None)], "i int, x double")
    got = {r.i: r.t for r in df.select("i", fmt.score_percent("x").alias("t")).collect()}
    assert got.pop(-1) == "0.0%"
    assert [(xs[i], got[i]) for i in got if got[i] != f"{xs[i] * 100:.1f}%"] == []
