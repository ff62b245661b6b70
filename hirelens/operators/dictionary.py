"""P8 with the dictionary as a table: whole-word terms and phrases of any number, in one pass over the texts.

The rule is the one of :func:`hirelens.functions.text.word_regex`: a boundary (between a word character and
none) on either side of the term.  So a term cut into runs of word characters and of others is a sequence of
whole consecutive runs of the text, the others between two words.  Texts are keyed by every such sequence of up to three runs
(of the shapes that terms have), a term of up to three by itself: an equi-join finds and decides it, no expression runs.
Longer terms are looked up by a part of them, and the regular expression decides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import NON_WORD, WORD, WORD_BEFORE
from hirelens.operators.joins import join_keyed
from hirelens.session import scratch_path

#: Shapes of keys, w a run of word characters and o one of others: (number of runs, whether the first is a word).
SHAPES = {"w": (1, True), "o": (1, False), "wo": (2, True), "ow": (2, False), "wow": (3, True), "owo": (3, False)}


def runs(text: Column) -> Column:
    """The text cut into runs of word characters and of others."""
    return F.regexp_extract_all(text, F.lit(f"{WORD}+|{NON_WORD}+"), F.lit(0))


def inner(r: Column) -> Column:
    """The runs from the first word to the last: others at the ends have no boundary on one side."""
    word = lambda x: x.rlike(f"^{WORD}")
    head = F.when((F.size(r) > 0) & ~word(F.get(r, F.lit(0))), 1).otherwise(0)
    tail = F.when((F.size(r) > 0) & ~word(F.get(r, F.size(r) - 1)), 1).otherwise(0)
    return F.slice(r, head + 1, F.greatest(F.size(r) - head - tail, F.lit(0)))


def keys_of(r: Column, shape: str) -> Column:
    """The sequences of a shape in the :func:`inner` runs, where words and others take turns."""
    n, word = SHAPES[shape]
    first, last = (1 if word else 2), F.size(r) - n + 1
    at = lambda i: F.concat(*[F.get(r, i + (j - 1)) for j in range(n)])
    return F.when(last >= first, F.transform(F.sequence(F.lit(first), F.greatest(last, F.lit(first)), F.lit(2)), at)).otherwise(F.array().cast("array<string>"))


def bounded(term: Column) -> Column:
    """The pattern of a term: quoted, with the boundary its first and last character ask for."""
    head = F.when(term.rlike(f"^{WORD}"), f"(?<!{WORD_BEFORE})").otherwise(f"(?<={WORD_BEFORE})")
    tail = F.when(term.rlike(f"(?s){WORD}\\z"), f"(?!{WORD})").otherwise(f"(?={WORD})")
    return F.concat(head, F.regexp_replace(term, r"([^\p{L}\p{N}_])", r"\\$1"), tail)


def dictionary_matches(texts: DataFrame, terms: DataFrame, scratch: str | None = None) -> DataFrame:
    """(id, term) for the ``texts`` (id, text; written, ids unique, already lower-cased as the rule asks) with a
    term of ``terms`` (term).  Null and empty terms are no terms, repeated ones count once."""
    spark = texts.sparkSession
    scratch = scratch or scratch_path(spark, f"dictionary-{uuid.uuid4().hex}")
    t = terms.select("term").filter("term != ''").distinct().withColumn("w", runs(F.col("term")))
    n, word = F.size("w"), F.get("w", F.lit(0)).rlike(f"^{WORD}")
    # a longer term by its first word and the two runs after it
    start = F.when((n > 3) & ~word, 2).otherwise(1)
    t = t.select("term", (n <= 3).alias("single"), F.array_join(F.slice("w", start, F.least(n, F.lit(3))), "").alias("key"),
                 F.concat(F.when(word | (n > 3), "w").otherwise("o"), F.least(n, F.lit(3)).cast("string")).alias("shape"))
    t = _written(t, f"{scratch}/terms")
    asked = {r["shape"] for r in t.select("shape").distinct().collect()}  # six at most
    shapes = [s for s, (k, w) in SHAPES.items() if f"{'w' if w else 'o'}{k}" in asked]
    if not shapes:
        return texts.select("id").withColumn("term", F.lit("")).limit(0)
    d = texts.filter("text is not null").withColumn("w", F.explode(F.array(runs(F.col("text"))))).withColumn("w", F.explode(F.array(inner(F.col("w")))))
    keys = d.select("id", F.explode(F.array_distinct(F.concat(*[keys_of(F.col("w"), s) for s in shapes]))).alias("key"))
    has = _written(keys.join(t.select("key").distinct(), "key", "left_semi"), f"{scratch}/has")
    counts = has.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    listed = t.groupBy("key").agg(F.collect_list(F.struct("term", "single")).alias("terms")).join(counts, "key")
    met = join_keyed(has, _written(listed, f"{scratch}/listed"), ["key"], "rows").select("id", F.explode("terms").alias("t"))
    met = _written(met.select("id", "t.term", "t.single"), f"{scratch}/met")
    unsure = met.filter("not single").select("id", "term")
    sure = unsure.join(texts.select("id", "text"), "id").filter(F.regexp_like("text", bounded(F.col("term")))).select("id", "term")
    return met.filter("single").select("id", "term").unionByName(sure)


def extract_skills_table(df: DataFrame, terms: DataFrame, fields: list[Column] = (), description: str = "description", seq: str = "input_seq",
                         name: str = "skills") -> DataFrame:
    """P8 for a dictionary table: ``df`` with the sorted distinct union of the lower-cased list fields and the terms found
    as whole words in the lower-cased description."""
    root = scratch_path(df.sparkSession, f"skills-{uuid.uuid4().hex}")
    texts = _written(df.select(F.col(seq).alias("id"), F.lower(F.coalesce(F.col(description), F.lit(""))).alias("text")), f"{root}/texts")
    found = dictionary_matches(texts, terms, root).groupBy(F.col("id").alias("_id")).agg(F.collect_set("term").alias("_found"))
    none = F.array().cast("array<string>")
    lists = [F.transform(F.coalesce(f, none), lambda s: F.lower(s)) for f in fields]
    out = df.join(found, df[seq] == found["_id"], "left")
    return out.withColumn(name, F.array_sort(F.array_distinct(F.concat(*lists, F.coalesce("_found", none))))).drop("_id", "_found")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
