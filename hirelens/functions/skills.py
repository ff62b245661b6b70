"""Skill lists (P8, X5, X10) and the three skill-matching flavours (substring, word, exact)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import col_, word_regex

# The reference's dictionary of technology terms looked up as whole
# words in the lower-cased description.
TECH_SKILLS = [
    "python", "javascript", "java", "c++", "c#", "go", "rust",
    "react", "angular", "vue", "node", "django", "flask", "spring",
    "sql", "mysql", "postgresql", "mongodb", "aws", "azure", "gcp",
    "docker", "kubernetes", "terraform", "ansible", "jenkins",
    "machine learning", "ai", "data science", "data engineering",
]


def split_csv(c) -> Column:
    """Comma text -> trimmed, non-empty items."""
    parts = F.transform(F.split(F.coalesce(col_(c), F.lit("")), ","), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def dictionary_hits(desc_lower: Column, terms: list[str]) -> Column:
    """Distinct terms found as whole words (Python ``\\b`` semantics) in the lower-cased text."""
    if not terms:
        return F.array().cast("array<string>")
    # a plain search first: the expression only where the text holds the term at all
    hits = [F.when(desc_lower.contains(F.lit(t)) & desc_lower.rlike(word_regex(t)), F.lit(t)) for t in dict.fromkeys(terms)]
    return F.array_except(F.array(*hits), _no_text())


def _no_text() -> Column:
    return F.array(F.lit(None).cast("string"))


def _lower_items(fields: list[Column]) -> list[Column]:
    return [F.transform(F.coalesce(f, F.array().cast("array<string>")), lambda s: F.lower(s)) for f in fields]


def extract_skills(fields: list[Column], desc: Column, terms: list[str] = TECH_SKILLS) -> Column:
    """Lower-cased items of the list fields + dictionary hits; sorted, distinct, a null last."""
    # a lambda's argument: lower-cased once, not once a term
    low = F.array(F.lower(F.coalesce(desc, F.lit(""))))
    hits = F.flatten(F.transform(low, lambda d: dictionary_hits(d, terms)))
    return F.array_sort(F.array_distinct(F.concat(*_lower_items(fields), hits)))


def skill_items(fields: list[Column], desc_lower: Column, terms: list[str] = TECH_SKILLS) -> Column:
    """P8 before :func:`sorted_items`, where the lower-cased text is a column."""
    return F.concat(*_lower_items(fields), dictionary_hits(desc_lower, terms))


def sorted_items(items: Column) -> Column:
    """A list column sorted, distinct, a null last.  ``array_sort`` has no generated code, which leaves all below it to be
    interpreted; ``sort_array`` has, but puts a null first.  The column is used twice: compute it once before."""
    return F.concat(F.sort_array(F.array_except(items, _no_text())), F.array_intersect(items, _no_text()))


def count_substring_hits(skills: Column, wanted: list[str]) -> Column:
    """M5: wanted terms that are a substring of any job skill (``java`` hits ``javascript``)."""
    if not wanted:
        return F.lit(0)
    s = F.coalesce(skills, F.array().cast("array<string>"))
    hits = [F.exists(s, _contains_term(w.lower())).cast("int") for w in wanted]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


def _contains_term(term: str):
    # A one-argument lambda: PySpark passes an index to two-argument lambdas.
    return lambda x: F.lower(x).contains(F.lit(term))


def count_exact_hits(skills: Column, wanted: list[str]) -> Column:
    """Wanted terms equal to a lower-cased job skill (duplicates in ``wanted`` count)."""
    if not wanted:
        return F.lit(0)
    low = F.transform(F.coalesce(skills, F.array().cast("array<string>")), lambda x: F.lower(x))
    hits = [F.array_contains(low, F.lit(w.lower())).cast("int") for w in wanted]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total
