"""Own matchers and own job boards."""

import pandas as pd
import pytest

from hirelens.operators import scoring, search
from hirelens.plans import catalog
from hirelens.sources import boards

SF = "/root/testdata/sf0.001"


class Listed:
    """A board without filters of its own: Spark tests them."""

    apply_where = False

    def __init__(self, n):
        self.n = n

    def search_jobs(self, job_type, location, keywords, max_results, where):
        for i in range(min(self.n, max_results)):
            yield {"input_seq": i, "title": f"{job_type} {i}", "location": location}


def test_board_finds_what_the_search_finds(spark, tmp_path):
    df = catalog.order_cleaned(spark, SF).select("input_seq", "title", "location", "description")
    df.write.parquet(str(tmp_path / "p"))
    args = (["order 1-urgent", "Order 3-medium"], ["Europe", None], ["ring", "widget"], 25)
    plain = search.search(df, *args)
    found = boards.read_board(spark, "hirelens.sources.boards:TableBoard", {"path": str(tmp_path / "p")}, *args)
    rows = lambda d: sorted((r.criterion, r.input_seq) for r in d.collect())
    assert rows(found) == rows(plain) and found.rdd.getNumPartitions() == 4
    test = "contains(title, 'building') and location = 'NATION_1, EUROPE'"
    assert rows(found.filter(test)) == rows(plain.filter(test))


def test_filters_are_taken_or_left(spark):
    r = boards.BoardReader({"board": "hirelens.sources.boards:TableBoard"})
    title, other = boards.StringContains(("title",), "x"), boards.EqualTo(("input_seq",), 3)
    assert list(r.pushFilters([title, other])) == [other] and r.where == {"title": ("contains", "x")}
    r = boards.BoardReader({"board": "tests.test_extension_points:Listed"})
    assert list(r.pushFilters([title, other])) == [title, other]
    names = [x["title"] for x in Listed(5).search_jobs("a", None, [], 3, {})]
    assert names == ["a 0", "a 1", "a 2"]


def test_a_matcher_returns_a_row_for_each_posting(spark):
    names = list(scoring.SCORES)

    class Short:  # local, so that it travels to the workers by value
        columns = ["title"]

        def score_batch(self, postings, profile):
            return pd.DataFrame({c: [0.0] * 3 for c in names})

    df = spark.createDataFrame([("a",), ("b",)], "title string").coalesce(1)
    with pytest.raises(Exception, match="one row for each posting"):
        scoring.score(df, {}, Short()).collect()
