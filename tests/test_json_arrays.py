"""S1 from array files: ranges of one file in many tasks, equal to the plain parser; numbers over files."""

import json
import random
from pathlib import Path

import pytest

from hirelens.plans import catalog, pipelines
from hirelens.sources import json_arrays, postings

SF = "/root/testdata/sf0.001"


def test_files_grow_in_number_with_the_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(catalog, "_scratch", lambda spark, name: f"{tmp_path}/{name}")
    whole = catalog.q_s1_json_arrays(spark, SF).collect()
    monkeypatch.setattr(catalog, "_scratch", lambda spark, name: f"{tmp_path}/more-{name}")
    monkeypatch.setattr(catalog, "ARRAY_RECORDS", 20, raising=False)
    cut = catalog.q_s1_json_arrays(spark, SF).collect()
    key = lambda rows: sorted(map(str, rows))
    sizes = [len(json.loads(p.read_text())) for p in Path(tmp_path, "more-json-arrays").glob("kind=*/bucket=*/part-*")]
    assert key(cut) == key(whole) and sum(sizes) >= len(cut) > 0
    assert max(sizes) < 60 and len(sizes) > 32


def awkward(rng, n):
    """Elements with brackets, quotes and backslashes in strings, nesting, and elements that are no objects."""
    texts = ['a } b', '{"x": [', '\\', '\\"', '"', '\\\\"}', "é𝒳 ]", "", "line\nbreak", "[{}]"]
    out = []
    for i in range(n):
        out.append(rng.choice([
            {"id": i, "t": rng.choice(texts)}, {"id": i, rng.choice(texts): {"y": [{}, {"z": rng.choice(texts)}]}}, {},
            [{"a": i}, "}", [i]], rng.choice(texts), i, None, True, {"id": i, "pad": "p" * rng.randrange(400), "t": rng.choice(texts) * 3}]))
    return out


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def elements(spark, paths, corrupt="file"):
    df = json_arrays.read_arrays(spark, list(enumerate(paths)), corrupt)
    rows = df.selectExpr("source_ord", "path", "offset", "to_json(struct(v)) AS j").collect()
    assert len({(r.path, r.offset) for r in rows}) == len(rows)
    got = {}
    for r in sorted(rows, key=lambda r: (r.source_ord, r.path, r.offset)):
        # a null element is left out of the struct's text
        got.setdefault(Path(r.path).name, []).append(json.loads(r.j).get("v"))
    return got


def test_one_file_in_many_ranges_equals_the_parser(spark, tmp_path, small_ranges):
    rng = random.Random(4)
    items = {"a.json": awkward(rng, 400), "b.json": awkward(rng, 5), "empty.json": [], "scalars.json": [1, "x}", None, 2.5], "one.json": [{"k": "}" * 20_000}, {"k": 1}]}
    for name, xs in items.items():
        (tmp_path / name).write_text(json.dumps(xs, indent=rng.choice([None, 2]), ensure_ascii=False) + rng.choice(["", "\n", " \n"]))
    stretches = json_arrays.stretches(spark, [str(tmp_path / "a.json")], 0)
    assert stretches.rdd.getNumPartitions() > 4 and stretches.select("block").distinct().count() > 4
    got = elements(spark, [str(tmp_path)])
    assert got == {n: xs for n, xs in items.items() if xs}


def test_corrupt_files(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    sound = [{"id": i, "t": "x" * rng.randrange(100)} for i in range(300)]
    text = json.dumps(sound)
    bad = {"cut.json": text[:len(text) * 2 // 3], "object.json": json.dumps({"a": sound}), "lines.json": "\n".join(map(json.dumps, sound)), "none.json": "",
           "comma.json": text[:-1] + ",]", "missing.json": text.replace("}, {", "} {", 1), "after.json": text + " x", "twice.json": text + text, "blank.json": " \n",
           "quote.json": text.replace('"id": 100,', '"id: 100,', 1), "broken.json": "[{"}
    for name, t in bad.items():
        (tmp_path / name).write_text(t)
    (tmp_path / "sound.json").write_text(text)
    assert elements(spark, [str(tmp_path), str(tmp_path / "gone.json")]) == {"sound.json": sound}
    got = elements(spark, [str(tmp_path)], "tail")
    cut = len(got["cut.json"])
    assert 190 < cut < 210 and got["cut.json"] == sound[:cut]
    assert got["quote.json"] == sound[:100] and got["missing.json"] == sound[:1] and got["after.json"] == got["comma.json"] == got["twice.json"][:300] == sound
    assert set(got) == {"sound.json", "cut.json", "quote.json", "missing.json", "after.json", "comma.json", "twice.json"}
    assert json_arrays.read_arrays(spark, [(0, str(tmp_path / "gone.json"))]).count() == 0


def test_numbers_are_unique_over_files_and_cleaning_keeps_other_rows(spark, tmp_path):
    """A copy in one file takes no row of another file with it."""
    job = lambda i: {"id": str(i), "title": f"Data engineer {i}", "description": f"text {i}", "url": f"https://www.linkedin.com/jobs/{i}"}
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "1.json").write_text(json.dumps([job(1), job(1)]))
    (tmp_path / "l" / "2.json").write_text(json.dumps([job(3), job(4)]))
    (tmp_path / "u.json").write_text(json.dumps([job(5), "no record", job(1), job(6)]))
    raw = postings.read_postings(spark, {"linkedin": str(tmp_path / "l"), "upwork": str(tmp_path / "u.json")})
    rows = raw.orderBy("input_seq").collect()
    assert [r.id for r in rows] == ["1", "1", "3", "4", "5", None, "1", "6"] and [r.record_ok for r in rows].count(False) == 1
    assert len({r.input_seq for r in rows}) == 8 and [r.file_source for r in rows] == ["linkedin"] * 4 + ["upwork"] * 4
    ok, rejects = pipelines.clean(raw, near_dedup=False)
    assert [r.id for r in ok.orderBy("input_seq").collect()] == ["1", "3", "4", "5", "6"]
    assert [r.reject_reason for r in rejects.collect()] == ["not_object"]
