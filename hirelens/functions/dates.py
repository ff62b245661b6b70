"""Date normalisation (P7) and default dates (X11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import col_

# The three accepted layouts, tried in order after cutting the text
# at the first '+' (an ISO form is accepted only with a fraction of a second).
DATE_LAYOUTS = ["yyyy-M-d'T'H:m:s.SSSSSS", "yyyy-M-d H:m:s", "yyyy-M-d"]


def parse_posted_date(c) -> Column:
    """First layout that parses the text before '+' -> DATE, else null."""
    x = F.split_part(col_(c).cast("string"), F.lit("+"), F.lit(1))
    # What a layout cannot parse for lack of its literals is not tried: a failed parse throws, which costs far more.
    may = [x.contains("."), x.contains(" "), ~(x.contains(" ") | x.contains(":"))]
    parsed = [F.when(m, F.try_to_timestamp(x, F.lit(fmt))) for m, fmt in zip(may, DATE_LAYOUTS)]
    return F.when(F.coalesce(col_(c).cast("string"), F.lit("")) != "", F.coalesce(*parsed).cast("date"))


def default_date(c, run_date: str) -> Column:
    """X11: ``posted_date`` when set, else the explicit load date."""
    return F.coalesce(F.nullif(col_(c).cast("string"), F.lit("")).cast("date"), F.lit(run_date).cast("date"))
