"""Text rules as Column expressions (JVM-side, inside whole-stage codegen).

Python's ``str`` semantics are reproduced with explicit Unicode classes, because
Java's ``\\w``/``\\s``/``trim`` differ from Python's:

* a *word character* is a letter, a number or ``_`` (Python's ``\\w``);
* ``strip()`` removes every white-space character, Spark's ``trim`` only spaces;
* ``isprintable()`` is false for categories C*, Zl, Zp and Zs other than the space.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"
# The same class for look-behind: Java looks back by a whole character, not by half a surrogate pair,
# only if the pattern itself holds a character beyond U+FFFF (here a letter, so the class is the same).
WORD_BEFORE = "[\\p{L}\\p{N}_\U0001D4B3]"
# Python's str.isspace(): Java's white-space set plus the ASCII separators 0x1C-0x1F.
SPACE_CHARS = r"\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{SPACE_CHARS}]"
SPACE_LIST = [*"\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200b))]
# One class, and printable ASCII left out first: far faster on texts that hold nothing else.
NON_PRINTABLE = r"[[^ -~]&&[\p{C}\p{Zl}\p{Zp}[^\P{Zs} ]]]"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading/trailing white space of every kind."""
    x = col_(c)
    # the expression tries every place of a text: only where an end asks for it
    ends = F.substring(x, 1, 1).isin(SPACE_LIST) | F.substring(x, -1, 1).isin(SPACE_LIST)
    return F.when(ends, F.regexp_replace(x, rf"^{SPACE}+|{SPACE}+$", "")).otherwise(x)


def clean_text(c) -> Column:
    """Drop non-printable characters first, collapse spaces, trim; null -> ''.

    Because tab and newline are non-printable they vanish *before* splitting, so
    ``'a\\tb\\nc'`` becomes ``'abc'`` exactly as in the reference rule.
    """
    x = F.regexp_replace(F.coalesce(col_(c).cast("string"), F.lit("")), NON_PRINTABLE, "")
    return F.trim(F.regexp_replace(x, " {2,}", " "))


def contains_any(text: Column, terms: list[str]) -> Column:
    """Substring test of any (already lower-cased) literal term; False for no terms."""
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [text.contains(F.lit(t)) for t in terms])


def count_contained(text: Column, terms: list[str]) -> Column:
    """Number of terms occurring as a substring (duplicates in ``terms`` count twice)."""
    if not terms:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [text.contains(F.lit(t.lower())).cast("int") for t in terms])


def word_regex(term: str) -> str:
    r"""Java regex equal to Python's ``\b<escaped term>\b``.

    ``\b`` is a boundary between a word and a non-word character, so its meaning
    depends on the term's first/last character: after ``c++`` it demands a word
    character (``c++11`` matches, ``c++ developer`` does not).  The term stands first, so that
    the classes are tried only where the text has it: the look-behind goes back over the term.
    """
    body = re.escape(term)  # escapes only non-alphanumerics: valid Java as well
    first_word = bool(re.match(r"\w", term[:1]))
    last_word = bool(re.match(r"\w", term[-1:]))
    head = f"(?<!{WORD_BEFORE}{body})" if first_word else f"(?<={WORD_BEFORE}{body})"
    tail = f"(?!{WORD})" if last_word else f"(?={WORD})"
    return body + tail + head


def match_text(text: Column) -> Column:
    """Matcher text: lower-case with every non-word, non-space character -> space."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), rf"[[^a-z0-9_ ]&&[^\p{{L}}\p{{N}}_{SPACE_CHARS}]]", " ")


def tokens(clean: Column) -> Column:
    """Vectoriser tokens of a :func:`match_text`: maximal runs of >= 2 word characters."""
    return F.regexp_extract_all(clean, F.lit(WORD + "{2,}"), F.lit(0))
