"""Joins that do not leave a frequent key to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than one part in HOT_PARTS of the rows are joined by broadcast.
HOT_PARTS = 512


def join_keyed(rows: DataFrame, keyed: DataFrame, on: list[str], size: str) -> DataFrame:
    """``rows`` joined (inner) with ``keyed``, which has one row per key and in ``size`` the number
    of ``rows`` of that key.  The keys that hold more than 1/HOT_PARTS of the matching rows, fewer than
    HOT_PARTS by definition, are broadcast; the others go by Spark's own choice of join.  So no task gets
    a hot key's rows.  ``rows`` and ``keyed`` are read twice: pass written tables."""
    total = keyed.agg(F.sum(size)).first()[0] or 0
    bar = total // HOT_PARTS
    hot = keyed.filter(F.col(size) > bar)
    few = keyed.filter(F.col(size) <= bar)
    near = rows.join(F.broadcast(hot), on)
    far = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(few, on)
    return near.unionByName(far)
