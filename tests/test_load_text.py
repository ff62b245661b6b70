"""Load from text with rejects, once-per-profile notification, observed counts, bounded streaming state."""

import datetime
import decimal
import json

from hirelens.operators import load, notify_log, validate
from hirelens.plans import pipelines
from hirelens.streaming import ingest

COLS = ["input_seq", "id", "title", "remote", "posted_date", "salary", "skills", "match_score", "skill_score", "client_rating"]


def text_rows(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "input_seq long, " + ", ".join(f"{c} string" for c in COLS[1:]))


def test_faults_in_order_and_exact_figures(spark):
    good = ("a", "T", "Yes", "2024-02-29", "{'min': 1000.12345, 'max': 2e13, 'currency': 'USD', 'period': 'year'}", "x, y,", "0.73125", " 1e-1 ", "4.5")
    change = lambda **k: tuple(k.get(c, v) for c, v in zip(COLS[1:], good))
    rows = [good, change(match_score="n/a", skill_score="bad"), change(match_score=""), change(skill_score=None), change(match_score="NaN"), change(match_score="1e14"),
            change(skill_score="-Infinity"), change(match_score="1d"), change(match_score="99999999999999"), change(posted_date="29.2.2024"), change(posted_date="2023-02-29"),
            change(salary="{'min': 1e14, 'max': 1}"), change(salary="no dict", posted_date="", remote="nein", skills=None, client_rating="good")]
    listings, bad = load.load_text(text_rows(spark, rows), "2025-01-01")
    assert {(r.input_seq, r.reject_column, r.reject_reason, r.reject_value) for r in bad.collect()} == {
        (1, "match_score", "not a number", "n/a"), (2, "match_score", "not a number", ""), (3, "skill_score", "not a number", ""), (4, "match_score", "not a number", "NaN"),
        (5, "match_score", "out of range", "1e14"), (6, "skill_score", "not a number", "-Infinity"), (7, "match_score", "not a number", "1d"),
        (9, "posted_date", "not a date", "29.2.2024"), (10, "posted_date", "not a date", "2023-02-29"), (11, "salary_min", "out of range", "1.0E14")}
    got = {r.input_seq: r for r in listings.collect()}
    assert set(got) == {0, 8, 12} and sorted(r.id for r in got.values()) == [1, 2, 3]
    assert listings.schema["match_score"].dataType.simpleString() == "decimal(18,4)"
    assert got[0].match_score == decimal.Decimal("0.7313") and got[0].skill_score == decimal.Decimal("0.1000") and got[0].location_score == 0
    assert got[0].salary_min == decimal.Decimal("1000.1235") and got[0].salary_max == decimal.Decimal("20000000000000") and got[8].match_score == decimal.Decimal("99999999999999")
    assert got[12].posted_date == datetime.date(2025, 1, 1) and got[12].salary_min is None and got[12].remote is False and got[12].skills == []
    empty, none = load.load_text(text_rows(spark, []), "2025-01-01")
    assert empty.count() == none.count() == 0


def test_an_epoch_sends_once(spark, tmp_path):
    log = str(tmp_path / "log")
    scored = spark.createDataFrame([(p, f"j{i}", i, 0.9 - i / 100) for p in ("a", "b") for i in range(8)] + [("c", "j0", 0, 0.1)], "profile string, id string, input_seq long, match_score double")
    def sent(epoch, day, df=scored, **kw):
        return sorted((r.profile, r.id) for r in notify_log.notify_once(df, log, epoch, day, max_jobs=3, **kw).collect())
    assert sent(1, "2025-01-01") == [(p, f"j{i}") for p in "ab" for i in range(3)]
    assert sent(1, "2025-01-01") == []  # a replay
    assert sent(1, "2025-01-01", scored.filter("profile = 'a'")) == []
    assert sent(2, "2025-01-02", scored.filter("profile = 'b'")) == [("b", f"j{i}") for i in range(3, 6)]
    assert sent(3, "2025-01-03") == [*[("a", f"j{i}") for i in range(3, 6)], ("b", "j6"), ("b", "j7")]
    assert sent(4, "2025-01-20", expiry_days=18) == [("a", "j0"), ("a", "j1"), ("a", "j2"), ("b", "j0"), ("b", "j1"), ("b", "j2")]  # of 1 January: forgotten
    assert sent(5, "2025-01-03", scored.limit(0)) == [] and notify_log.recorded(spark, log, 5).count() == 0
    assert not [p for p in (tmp_path / "log").iterdir() if p.name.startswith("_staged")]


def test_a_run_that_dies_before_its_record_sends_nothing_and_is_run_again(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    scored = spark.createDataFrame([("a", "j1", 1, 0.9)], "profile string, id string, input_seq long, match_score double")
    real = notify_log._fs
    monkeypatch.setattr(notify_log, "_fs", lambda s, p: (_ for _ in ()).throw(RuntimeError("lost")) if "_staged" in p else real(s, p))
    try:
        notify_log.notify_once(scored, log, 1, "2025-01-01")
        raise AssertionError("not lost")
    except RuntimeError:
        pass
    monkeypatch.setattr(notify_log, "_fs", real)
    assert notify_log.recorded(spark, log, 1) is None
    assert [r.id for r in notify_log.notify_once(scored, log, 1, "2025-01-01").collect()] == ["j1"]


def test_observed_counts_equal_counting(spark, tmp_path):
    from hirelens.plans import catalog
    from hirelens.sources.tables import doc_postings

    sf = "/root/testdata/sf0.001"
    raw = doc_postings(spark, sf)
    for near in (False, True):
        cleaned, rejects, steps = pipelines.clean_observed(raw, str(tmp_path / str(near)), near, catalog.DOC_DICTIONARY)
        ok, bad = pipelines.clean(raw, near, catalog.DOC_DICTIONARY)
        key = lambda df: sorted(map(str, df.collect()))
        assert key(cleaned.select(ok.columns)) == key(ok) and key(rejects) == key(bad)
        assert [(s["stage"], s["n_in"], s["n_out"], s["n_dropped"]) for s in steps] == [tuple(r) for r in pipelines.clean_metrics(raw, near, catalog.DOC_DICTIONARY).orderBy("n_in", ascending=False).collect()]
    listed = text_rows(spark, [("a", "T", "", "", "", "", "1", "1", ""), ("b", "T", "", "", "", "", "x", "1", ""), ("c", "T", "", "", "", "", "1", "1", "")])
    old = spark.createDataFrame([("upwork", "c")], "source string, external_id string")
    listings, bad, steps = pipelines.load_observed(listed, str(tmp_path / "load"), "2025-01-01", 5, old)
    assert [(s["n_in"], s["n_out"]) for s in steps] == [(3, 2), (2, 1)] and [r.id for r in listings.collect()] == [5] and bad.count() == 1


def test_streaming_state_is_bounded_and_late_copies_defined(spark, tmp_path):
    landing, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    def post(i, day, title):
        return json.dumps({"input_seq": i, "id": i, "title": title, "source": "upwork", "collected_at": f"{day}T08:00:00Z"})
    held = []
    def land(*records):
        spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.mode("append").text(landing)
        progress = ingest.run_available(spark, landing, out, state, lambda b: validate.valid(b).select("input_seq", "title"), delay="10 days")
        held.append(progress[-1]["state"])
        return sorted(r.input_seq for r in spark.read.schema("input_seq long, title string, batch int").parquet(out).collect())
    day = lambda n: str(datetime.date(2025, 1, 1) + datetime.timedelta(days=n))
    title = lambda k: f"A long enough title {k}"
    assert land(*[post(i, day(0), title(i)) for i in range(50)], post(100, day(1), title(0))) == list(range(50))  # a copy a day later
    assert land(post(101, day(9), title(1)), post(200, day(9), title(200))) == [*range(50), 200]
    for n in range(3, 9):  # a new posting every ten days
        rows = land(post(300 + n, day(10 * n), title(f"x{n}")))
    assert rows == [*range(50), 200, *range(303, 309)] and held[0] >= 50 and max(held[-3:]) <= 6
    assert land(post(400, day(81), title(2)))[-1] == 400       # forgotten: a new posting
    assert 401 not in land(post(401, day(2), title("late")))   # behind the watermark: dropped
