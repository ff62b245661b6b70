"""JSON presence rules, page attributes, streaming ingest, plans of the clean stage."""

import json

from pyspark.sql import functions as F

from hirelens.operators import dedup, normalize, pages
from hirelens.operators.validate import valid
from hirelens.plans import catalog
from hirelens.sources import postings as src
from hirelens.sources.tables import order_postings
from hirelens.streaming import ingest

SF = "/root/testdata/sf0.001"


def cleaned(spark, **record):
    base = {"id": 1, "title": "A long enough title", "url": "https://www.upwork.com/jobs/1", "input_seq": 1}
    df = spark.createDataFrame([(json.dumps({**base, **record}),)], "value string")
    return normalize.normalize(src.lines_to_raw(df)).first()


def test_remote_is_the_truth_of_a_present_key(spark):
    for value, want in [(None, False), (False, False), (True, True), ("no", True), ("False", True), ("", False), (0, False), (2, True),
                        (["x"], True), ([], False), ({}, False), ({"a": 1}, True)]:
        assert cleaned(spark, remote_derived=value).remote is want, value
    assert cleaned(spark, location="Paris").remote is False
    assert cleaned(spark).remote is True  # a missing location reads "Remote"


def test_null_client_country_is_an_empty_location(spark):
    r = cleaned(spark, client_country=None, location="Paris")
    assert r.location == "" and r.remote is False
    assert cleaned(spark, client_country="Norway", location="Paris").location == "Norway"
    assert cleaned(spark, client_country=None, locations_derived=["Oslo"]).location == "Oslo" and cleaned(spark, location="Paris").location == "Paris"


def test_page_details_by_expressions(spark):
    html = """<html><head><title>A &amp; B</title><script>var x = "<h1>no</h1>"</script></head><body><!-- <p>no</p> -->
      <div class="x top-card-layout__card y"><a href="/c"><img src="l.png" alt="Acme &amp; Co"></a></div>
      <div class='top-card-layout__entity-info'><a>Data <b>engineer</b></a></div><span class="topcard__flavor">no</span>
      <span class="topcard__flavor topcard__flavor--bullet"> Oslo,\n Norway </span>
      <ul class="description__job-criteria-list"><li><h3>Seniority level</h3><span>Mid</span></li><li>no</li></ul>
      <section class="core-section-container my-3 description"><div class="description__text description__text--rich">Line <br>two &lt;3</div></section>
      <h1 id="1">Head</h1><p>First</p></body></html>"""
    r = pages.page_details(spark.createDataFrame([(7, html), (8, "<p>only"), (9, None)], "page_id long, html string")).orderBy("page_id").collect()
    assert (r[0].job_id, r[0].job_title, r[0].level, r[0].location, r[0].description) == ("7", "Data engineer", "Mid", "Oslo, Norway", "Line two <3")
    assert (r[0].page_title, r[0].h1, r[0].first_p, r[0].applicants) == ("A & B", "Head", "First", None) and r[0].company == "Acme &amp; Co"
    assert [x.first_p for x in r[1:]] == [None, None]


def test_null_hourly_maximum_is_a_reject(spark):
    bad = cleaned(spark, project_budget_hourly_min=10, project_budget_hourly_max=None)
    assert bad.reject_reason == "salary_unparsable"
    ok = cleaned(spark, project_budget_hourly_min=10)
    assert ok.reject_reason is None and ok.salary["max"] == 10.0


def test_client_without_name_and_null_fields(spark):
    r = cleaned(spark, client={}, company="Other")
    assert r.company == "" and r.source == "upwork"
    assert cleaned(spark, client="text", company="Other").company == "Other"
    assert cleaned(spark, project_type=None).job_type is None and cleaned(spark).job_type == "Contract"
    r = cleaned(spark, category=None, category_group="G")
    assert r.category is None and r.category_group == "G"
    assert cleaned(spark, category_group="G").category_group is None


def test_listing_ids_by_class_token(spark):
    html = """<ul><li><div data-entity-urn="a:b:c:41" class="x base-card y"></div></li>
    <li><div class='base-card' data-entity-urn='a:b:c:42'></div></li><li><div class="base-card-link" data-entity-urn="a:b:c:43"></div></li>
    <li><div class="other"></div><div class="base-card" data-entity-urn="a:b:c:44"></div></li><li><div class="base-card"></div></li>
    <li><div class="base-card" data-entity-urn="a:b"></div></li><li></li></ul>"""
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id long, html string")
    assert [r.listing_id for r in pages.extract_listing_ids(df).orderBy("item_pos").collect()] == ["41", "42", "44"]


def test_stream_drops_copies_across_batches(spark, tmp_path):
    landing, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def land(*records):
        spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1).write.mode("append").text(landing)

    def post(i, title):
        return {"input_seq": i, "id": i, "title": title, "source": "upwork"}

    land(post(1, "First long title"), post(2, "Second long title"), {"title": "without a number"})
    ingest.run_available(spark, landing, out, state, lambda b: valid(b).select("input_seq", "title"))
    land(post(3, "First long title "), post(4, "Third long title"), post(5, "short"))
    ingest.run_available(spark, landing, out, state, lambda b: valid(b).select("input_seq", "title"))
    got = [r.title for r in spark.read.parquet(out).collect()]
    assert sorted(got) == ["First long title", "Second long title", "Third long title"]


def test_clean_plan_computes_shared_parts_once(spark):
    plan = catalog.order_cleaned(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 12 and "Scan ExistingRDD" not in plan  # no checkpoint between scan and result


def test_dedup_exact_with_null_fields(spark):
    df = spark.createDataFrame([(2, None, "d", "u"), (1, "", "d", "u"), (3, "x", None, None)],
                               "input_seq long, title string, description string, url string")
    assert sorted(r.input_seq for r in dedup.dedup_exact(df).select("input_seq").collect()) == [1, 3]
    assert dedup.dedup_exact(df.limit(0)).agg(F.count("*")).first()[0] == 0
