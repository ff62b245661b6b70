"""Page extraction (S13, S14), re-aimed from live scraping to a table of page HTML.

Both are column expressions over the markup: items, first elements of a tag and class, and their
texts.  A page is one row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, in either kind of quotes; null if it has none."""
    pat = rf"""(?is)\s{re.escape(name)}\s*=\s*("[^"]*"|'[^']*')"""
    quoted = F.regexp_extract(tag, pat, 1)
    return F.when(quoted != "", F.substr(quoted, F.lit(2), F.length(quoted) - 2))


def extract_listing_ids(pages: DataFrame, html: str = "html", tag: str = "div", css_class: str | None = "base-card",
                        attr: str = "data-entity-urn", sep: str = ":", part: int = 3,
                        key: str = "page_id") -> DataFrame:
    """For each ``li`` item, the ``part``-th (0-based) ``sep``-separated piece of
    the ``attr`` of its first ``tag`` that has the class ``css_class`` (as one of its
    class names); items without one are skipped."""
    items = F.regexp_extract_all(F.col(html), F.lit(r"(?s)<li\b[^>]*>(.*?)</li>"), F.lit(1))

    def value(item: Column) -> Column:
        tags = F.regexp_extract_all(item, F.lit(rf"(?is)<{tag}(?=[\s>])[^>]*>"), F.lit(0))
        if css_class:
            names = lambda t: F.split(F.trim(F.coalesce(attribute(t, "class"), F.lit(""))), r"\s+")
            tags = F.filter(tags, lambda t: F.array_contains(names(t), css_class))
        return attribute(F.get(tags, F.lit(0)), attr)

    vals = F.transform(items, lambda it: value(it))
    out = pages.select(F.col(key), F.posexplode(vals).alias("item_pos", "attr_value"))
    piece = F.try_element_at(F.split(F.col("attr_value"), re.escape(sep)), F.lit(part + 1))
    return (out.withColumn("listing_id", piece)
            .filter(F.col("listing_id").isNotNull())
            .select(key, "item_pos", "listing_id"))


def page_fields_regex(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """S14 (regex form): page title, first h1 and first paragraph as raw inner markup."""
    def first(tag):
        return F.nullif(F.regexp_extract(F.col(html), rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1), F.lit(""))
    return pages.select(F.col(key), first("title").alias("page_title"), first("h1").alias("h1"),
                        first("p").alias("first_p"))


# ---------------------------------------------------------------- S14 details

# Where the detail page keeps a field: tag, classes, and what is taken of it.
DETAILS = {
    "job_title": [("div", "top-card-layout__entity-info"), ("a", "")],
    "level": [("ul", "description__job-criteria-list"), ("li", "")],
    "location": [("span", "topcard__flavor topcard__flavor--bullet")],
    "description": [("section", "core-section-container my-3 description"), ("div", "description__text description__text--rich")],
    "page_title": [("title", "")], "h1": [("h1", "")], "first_p": [("p", "")],
}
# The character references that are resolved, the ampersand last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def element(markup: Column, tag: str, classes: str) -> Column:
    """Inner markup of the first ``tag`` that has all the classes, up to its next closing tag; null if there is none."""
    names = "".join(rf"""(?=[^>]*\sclass\s*=\s*["'](?:[^"']*\s)?{re.escape(c)}[\s"'])""" for c in classes.split())
    found = F.regexp_extract_all(markup, F.lit(rf"(?is)<{tag}(?=[\s>]){names}[^>]*>(.*?)</{tag}\s*>"), F.lit(1))
    return F.get(found, F.lit(0))


def inner_text(markup: Column) -> Column:
    """The text of a stretch of markup: tags are gaps, white space collapsed, common character references resolved."""
    text = F.trim(F.regexp_replace(F.regexp_replace(markup, "<[^>]*>", " "), r"[ \t\r\n\f]+", " "))
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def page_details(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """S14 by column expressions: job_id, company, the fields of DETAILS and, as the reference leaves them, null
    fields.  A field is null where the page lacks its element.  Elements end at their next closing tag, so of an
    element that holds another one of its tag the part before that one's end is taken."""
    bare = F.regexp_replace(F.col(html), r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "")
    d = pages.select(F.col(key), F.explode(F.array(bare)).alias("_m"))

    def taken(path):
        inner = F.col("_m")
        for tag, classes in path:
            inner = element(inner, tag, classes)
        return inner_text(inner)
    # the logo of the card's first link; its text is the company
    card = element(F.col("_m"), "div", "top-card-layout__card")
    logo = F.regexp_extract(element(card, "a", ""), r"(?is)<img(?=[\s>])[^>]*>", 0)
    fields = {n: taken(p) for n, p in DETAILS.items()}
    fields["level"] = F.trim(F.replace(fields["level"], F.lit("Seniority level"), F.lit("")))
    missing = {n: F.lit(None).cast("string") for n in ("posted_at", "updated_at", "crawled_at", "job_function", "employment_type", "applicants", "industries")}
    return d.select(F.col(key), F.col(key).cast("string").alias("job_id"), attribute(logo, "alt").alias("company"), *[c.alias(n) for n, c in {**fields, **missing}.items()])
