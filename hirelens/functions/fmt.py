"""Display and load-time scalar rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import col_

SALARY_JSON_TYPE = "struct<min:double,max:double,currency:string,period:string>"
TRUE_WORDS = ["true", "1", "yes"]


def score_percent(c) -> Column:
    """``'%.1f%%'`` of score*100, rounded from the double's exact binary value, ties to the even digit.

    The fraction of a double is exact, and so are its products with 16 and 4; their sum, with the rounding
    error recovered, is 20 times the fraction, whose place among the odd numbers decides the digit.
    """
    x = F.coalesce(col_(c).cast("double"), F.lit(0.0)) * 100
    size = F.abs(x)
    whole = F.floor(size)
    f = size - whole.cast("double")
    a, b = f * 16, f * 4
    total = a + b
    back = total - a
    error = (a - (total - back)) + (b - back)
    tenth = F.floor(total / 2)
    rest = total - tenth.cast("double") * 2
    up = (rest > 1) | ((rest == 1) & ((error > 0) | ((error == 0) & (tenth % 2 == 1))))
    tenths = whole * 10 + tenth + up.cast("int")
    sign = F.when(x < 0, "-").otherwise("")
    return F.concat(sign, F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))


def location_display(remote: Column, location: Column, default: str = "Not specified") -> Column:
    """X3: 'Remote' when remote, else the location (or a default)."""
    return F.when(F.coalesce(remote, F.lit(False)), F.lit("Remote")).otherwise(F.coalesce(location, F.lit(default)))


def skills_preview(skills: Column, n: int = 5) -> Column:
    """First ``n`` skills joined by ', ' plus '+N more'."""
    s = F.coalesce(skills, F.array().cast("array<string>"))
    head = F.array_join(F.slice(s, 1, n), ", ")
    extra = F.size(s) - n
    return F.when(extra > 0, F.concat(head, F.lit(", +"), extra.cast("string"), F.lit(" more"))).otherwise(head)


def source_title(c) -> Column:
    """Source name in title case."""
    return F.initcap(col_(c))


def text_bool(c) -> Column:
    """Lower-case in {true, 1, yes}; anything else (and null) is false."""
    return F.coalesce(F.lower(col_(c).cast("string")).isin(TRUE_WORDS), F.lit(False))


def salary_from_text(c) -> Column:
    """Dict-like salary text -> struct; only text starting with '{' or a quote is parsed."""
    x = col_(c).cast("string")
    guarded = F.when(x.startswith("{") | x.startswith("'"), F.regexp_replace(x, "'", '"'))
    return F.from_json(guarded, SALARY_JSON_TYPE, {"mode": "PERMISSIVE"})


def number_or_zero(c) -> Column:
    """Numeric text -> double, default 0.0."""
    return F.coalesce(col_(c).cast("string").try_cast("double"), F.lit(0.0))
