"""Extension point for posting sources: a job board as a Spark data source.

A board is a class with ``search_jobs(job_type, location, keywords, max_results, where)`` that yields postings
as dictionaries of COLUMNS.  ``read_board`` asks it for every job type with every location, one
partition each, so the searches run side by side on the executors; ``where`` has the filters of the
query that the source takes over (equality and substring tests on texts), which a board tests on its results, so that
``max_results`` means the same with and without them; Spark tests them itself for a board that does not ``apply_where``.

:class:`TableBoard` is the board over a folder of Parquet postings.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition, StringContains

from hirelens.session import ship_package

COLUMNS = ("criterion", "input_seq", "title", "location", "description")
SCHEMA = "criterion string, input_seq long, title string, location string, description string"
#: Rows that a reader hands over at once.
BATCH = 1000


class JobBoard(Protocol):
    """What a board has to offer; its options are the keyword arguments of its constructor."""

    apply_where: bool

    def search_jobs(self, job_type: str, location: str | None, keywords: list[str], max_results: int, where: dict) -> Iterator[dict]: ...


class TableBoard:
    """Postings of a Parquet folder (input_seq, title, location, description), the first ones by input_seq."""

    apply_where = True

    def __init__(self, path: str):
        self.path = path

    def search_jobs(self, job_type, location, keywords, max_results, where):
        import heapq

        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        has = lambda column, text: pc.match_substring(pc.utf8_lower(pc.field(column)), text.lower())
        test = has("title", job_type)
        if location:
            test = test & has("location", location)
        if keywords:
            any_of = None
            for k in keywords:
                one = has("title", k) | has("description", k)
                any_of = one if any_of is None else any_of | one
            test = test & any_of
        rows = ds.dataset(self.path, format="parquet").scanner(columns=list(COLUMNS[1:]), filter=test)
        # a bounded heap of the first rows; the scan is in batches
        each = (r for b in rows.to_batches() for r in b.to_pylist())
        for r in heapq.nsmallest(max_results, each, key=lambda r: r["input_seq"]):
            if all(r[c] is not None and (r[c] == text if kind == "equals" else text in r[c]) for c, (kind, text) in where.items()):
                yield r


def _load(name: str):
    module, _, cls = name.partition(":")
    return getattr(importlib.import_module(module), cls)


class _Criterion(InputPartition):
    def __init__(self, job_type: str, location: str | None):
        self.job_type, self.location = job_type, location


class BoardReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.where = options, {}
        self.board = options["board"]

    def pushFilters(self, filters):
        takes = getattr(_load(self.board), "apply_where", False)
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | StringContains) and len(f.attribute) == 1 else None
            if column in ("title", "location", "description") and isinstance(f.value, str) and column not in self.where:
                self.where[column] = ("equals" if isinstance(f, EqualTo) else "contains", f.value)
                if takes:
                    continue
            yield f

    def partitions(self):
        return [_Criterion(t, loc) for t in json.loads(self.options["job_types"]) for loc in (json.loads(self.options["locations"]) or [None])]

    def read(self, partition):
        board = _load(self.board)(**json.loads(self.options.get("board_options", "{}")))
        name = partition.job_type if partition.location is None else f"{partition.job_type} @ {partition.location}"
        for r in board.search_jobs(partition.job_type, partition.location, json.loads(self.options["keywords"]), int(self.options["max_results"]), self.where):
            yield (name, *[r.get(c) for c in COLUMNS[1:]])


class BoardSource(DataSource):
    """``spark.read.format("job_board")``; see :func:`read_board` for the options."""

    @classmethod
    def name(cls) -> str:
        return "job_board"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BoardReader(dict(self.options))


def read_board(spark: SparkSession, board: str, board_options: dict, job_types: list[str], locations: list[str | None], keywords: list[str],
               max_results: int = 100) -> DataFrame:
    """The postings that ``board`` (``module:Class``, importable on the executors) finds for every job type with every location."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BoardSource)
    r = spark.read.format("job_board").option("board", board).option("board_options", json.dumps(board_options))
    return (r.option("job_types", json.dumps(list(job_types))).option("locations", json.dumps(list(locations or [])))
            .option("keywords", json.dumps(list(keywords))).option("max_results", str(max_results)).load())
