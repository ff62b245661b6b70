"""Salary rules (P9-P11, M7/M12 tiers, X2 text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import col_

# Fixed values that must equal the reference's rule: the three salary range
# patterns, tried in this order, case-insensitively, leftmost match wins.
# Python's named groups become Java's (?<name>...).
SALARY_PATTERNS = [
    r"(?<currency>\$|€|£)?\s*(?<min>[\d,]+)\s*[-–to]+\s*(?<currency2>\$|€|£)?\s*(?<max>[\d,]+)\s*(?<period>per year|per month|per hour|yearly|monthly|hourly)?",
    r"(?<currency>\$|€|£)?\s*(?<min>[\d,]+k)\s*[-–to]+\s*(?<currency2>\$|€|£)?\s*(?<max>[\d,]+k)\s*(?<period>per year|per month|per hour|yearly|monthly|hourly)?",
    r"(?<min>[\d,]+)\s*[-–to]+\s*(?<max>[\d,]+)\s*(?<currency>USD|EUR|GBP)",
]
# A part of every match of these patterns: from the last character of the minimum to the first of the maximum.
MAY_MATCH = r"(?iU)[\d,]k?\s*[-–to]+\s*(?:\$|€|£)?\s*[\d,]"
# Display symbol per ISO code, and the approximate conversion
# factors to USD applied to the minimum before tiering.
CURRENCY_SYMBOL = {"USD": "$", "EUR": "€", "GBP": "£"}
TO_USD = {"EUR": 1.1, "GBP": 1.3}
# Optional symbol -> ISO mapping (parsed salaries carry symbols).
SYMBOL_ISO = {"$": "USD", "€": "EUR", "£": "GBP"}

SALARY_TYPE = "struct<min:double,max:double,currency:string,period:string>"


SEP = "\u0001"
GROUPS = ["currency", "min", "currency2", "max", "period"]


def _groups(text: Column, pattern: str) -> Column:
    """All named groups of the leftmost match in one pass, as an array of 5 strings.

    ``^.*?(?:p).*$`` tries p at positions 0, 1, 2, ... like ``find()``; the replacement
    lists the groups (a group that did not take part yields '').  Call only where the
    pattern matches (otherwise the text comes back unchanged).
    """
    present = [g for g in GROUPS if f"(?<{g}>" in pattern]
    repl = SEP.join("${" + g + "}" if g in present else "" for g in GROUPS)
    return F.split(F.regexp_replace(text, "(?isU)^.*?(?:" + pattern + ").*$", repl), SEP, -1)


def _to_double(g: Column) -> Column:
    # Only a lower-case k is expanded; '50K' stays uncastable (a reject, as in the reference).
    s = F.regexp_replace(F.regexp_replace(g, "k", "000"), ",", "")
    return s.try_cast("double")


def _build(g: Column) -> Column:
    """Salary struct from the 5-slot group array (currency, min, currency2, max, period)."""
    def part(i):
        return F.nullif(F.element_at(g, i + 1), F.lit(""))

    return F.struct(
        _to_double(F.coalesce(part(1), F.lit(""))).alias("min"),
        _to_double(F.coalesce(part(3), F.lit(""))).alias("max"),
        F.coalesce(part(0), part(2), F.lit("USD")).alias("currency"),
        F.replace(F.lower(F.coalesce(part(4), F.lit("year"))), F.lit("per "), F.lit("")).alias("period"),
    )


def parse_salary_text(c, prefer_iso: bool = False) -> Column:
    """First pattern that matches (leftmost match) -> salary struct, else null.

    A match whose numbers do not convert (``50K-60K``, ``', to,'``) yields a struct
    with a null ``min`` or ``max``; :func:`salary_parse_failed` flags it, and the
    normalisation step routes such rows to the rejects table.  The group array is
    produced once per row and the struct is built inside a lambda over it.
    """
    text = col_(c)
    # One scan for what a match of any pattern holds; the patterns, far slower where nothing matches, only then.
    may = F.regexp_instr(text, F.lit(MAY_MATCH)) > 0
    patterns = SALARY_PATTERNS[2:] + SALARY_PATTERNS[:2] if prefer_iso else SALARY_PATTERNS
    groups = None
    for p in patterns:
        cond = text.rlike("(?iU)" + p)
        groups = F.when(cond, _groups(text, p)) if groups is None else groups.when(cond, _groups(text, p))
    built = F.transform(F.array(F.when(may, groups)), lambda g: F.when(g.isNotNull(), _build(g)))
    return F.element_at(built, 1)


def salary_parse_failed(sal: Column) -> Column:
    return sal.isNotNull() & (sal["min"].isNull() | sal["max"].isNull())


def upwork_salary(hourly_min, hourly_max, total, currency, max_null: Column | None = None) -> Column:
    """P10: hourly budget (an absent max is the min; a null one, flagged by ``max_null``, cannot be
    converted and makes the row a reject), else fixed total; zero/null = missing."""
    hmin, hmax, tot = col_(hourly_min).cast("double"), col_(hourly_max).cast("double"), col_(total).cast("double")
    cur = F.coalesce(col_(currency), F.lit("USD"))
    return (F.when(F.coalesce(hmin, F.lit(0.0)) != 0,
                   F.struct(hmin.alias("min"), (F.coalesce(hmax, hmin) if max_null is None else
                                            F.when(~max_null, F.coalesce(hmax, hmin))).alias("max"),
                            cur.alias("currency"), F.lit("hour").alias("period")))
            .when(F.coalesce(tot, F.lit(0.0)) != 0,
                  F.struct(tot.alias("min"), tot.alias("max"), cur.alias("currency"),
                           F.lit("fixed").alias("period")))
            .otherwise(F.lit(None).cast(SALARY_TYPE)))


def to_iso(currency: Column) -> Column:
    """Map a currency symbol to its ISO code; other values pass through."""
    expr = F.when(F.lit(False), F.lit(None))
    for sym, iso in SYMBOL_ISO.items():
        expr = expr.when(currency == F.lit(sym), F.lit(iso))
    return expr.otherwise(currency)


def converted_minimum(min_salary: Column, currency: Column) -> Column:
    """The minimum in USD, by the approximate factors; null counts as 0."""
    mn = F.coalesce(min_salary.cast("double"), F.lit(0.0))
    conv = mn
    for iso, factor in TO_USD.items():
        conv = F.when((currency == F.lit(iso)) & (mn > 0), mn * F.lit(factor)).otherwise(conv)
    return conv


def salary_tier(min_salary: Column, max_salary: Column, currency: Column, preferred: float | Column) -> Column:
    """Neutral 0.5 without figures, else tiers of the converted minimum."""
    mn = F.coalesce(min_salary.cast("double"), F.lit(0.0))
    mx = F.coalesce(max_salary.cast("double"), F.lit(0.0))
    return tier_of((mn != 0) | (mx != 0), converted_minimum(min_salary, currency), preferred)


def tier_of(has_figures: Column, conv: Column, preferred: float | Column) -> Column:
    """The tier of a converted minimum against the wanted one (a number, or a column of a profile table)."""
    p = F.coalesce(preferred.cast("double"), F.lit(0.0)) if isinstance(preferred, Column) else float(preferred or 0)
    return (F.when(~has_figures, F.lit(0.5))
            .when(conv >= p * 1.5, F.lit(1.0))
            .when(conv >= p * 1.2, F.lit(0.9))
            .when(conv >= p, F.lit(0.8))
            .when(conv >= p * 0.8, F.lit(0.6))
            .when(conv > 0, F.lit(0.4))
            .otherwise(F.lit(0.5)))


def salary_display(min_salary: Column, max_salary: Column, currency: Column) -> Column:
    """Symbol by ISO code, no decimals, thousands separators; '' when both <= 0."""
    mn = F.coalesce(min_salary.cast("double"), F.lit(0.0))
    mx = F.coalesce(max_salary.cast("double"), F.lit(0.0))
    sym = F.coalesce(F.try_element_at(F.create_map(*[x for kv in CURRENCY_SYMBOL.items() for x in map(F.lit, kv)]),
                                  F.coalesce(currency, F.lit(""))), F.lit(""))
    one = F.concat(sym, F.format_number(mn, 0))
    two = F.concat(sym, F.format_number(mn, 0), F.lit(" - "), sym, F.format_number(mx, 0))
    return F.when((mn > 0) | (mx > 0), F.when(mn == mx, one).otherwise(two)).otherwise(F.lit(""))
