"""Operator 5, line dedup: a log-template tree of fixed depth.  DataFrame functions only.

The tree is keyed, not built: a line (white space collapsed, tokens that hold a
digit masked to ``<*>``, if that leaves ``similarity`` of them) belongs to the leaf of its token count and its first ``depth``
tokens.  Within a leaf, a token is constant if two different lines have it at that place;
otherwise the place is a variable field.  A line's template keeps the constants and masks the
fields, if the line has at least ``min_general`` tokens and at least ``similarity`` of the
tokens after the leading ones are constant; else the masked line is its own template.

A template is recurring if it is found in two different documents, and, below ``min_tokens``
tokens, in at least ``min_short`` lines.  Its lines are dropped everywhere but in the document
of the smallest doc_id that has it, so that of a passage that many documents share (and of
copies of documents) one instance stays.

Only leaves that two documents share are looked into.  All statistics are sums, minima and
maxima, which combine before the shuffle; the join that finds the shared leaves' lines is before it.  A document's text is rebuilt from its own line numbers, without sorting lines.

Defined results: null texts stay null; empty lines and lines without tokens are never dropped;
rows without doc_id count as one document, later than all others; repeated rows get the same
result; lines are cut at a newline only; an empty table gives no rows; all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, join_keyed, table, text_key

DEPTH = 3
MIN_GENERAL = 8
SIMILARITY = 0.75
MIN_TOKENS = 5
MIN_SHORT = 10
#: Words of a shingle, by which near copies are proven.
SHINGLE = 5
MASK = "<*>"
LAST_ID = (1 << 63) - 1


def masked(line: Column) -> Column:
    """White space collapsed and tokens with digits masked, if enough others are left (a row of
    numbers stays as it is); most lines need neither."""
    plain = F.trim(F.regexp_replace(line, r"[ \t\r\f\x0B]+", " "))
    tokens = F.split(F.regexp_replace(plain, "[^ ]*[0-9][^ ]*", MASK), " ")
    fields = F.size(F.filter(tokens, lambda t: t == MASK))
    few = fields <= (1 - SIMILARITY) * F.size(tokens)
    return (F.when(~line.rlike(r"[0-9\t\r\f\x0B]|  "), F.trim(line))
            .when(few, F.array_join(tokens, " ")).otherwise(plain))


def line_rows(docs: DataFrame) -> DataFrame:
    """doc (id for comparison), text_key, pos, m (masked line), n (tokens), leaf."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), text_key("text").alias("text_key"),
                    F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    d = d.filter("line != ''").select("doc", "text_key", "pos", masked(F.col("line")).alias("m"))
    return d.withColumn("n", F.size(F.split("m", " "))).withColumn("leaf", F.xxhash64("n", F.substring_index("m", " ", DEPTH)))


def recurring(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(lines: doc, text_key, pos, n, leaf, line_key), (found: leaf, line_key, first): the lines of
    ``found`` are dropped from all documents but ``first``."""
    lines = scratch.write(line_rows(docs).select("doc", "text_key", "pos", "n", "leaf", F.xxhash64("m").alias("line_key")), "lines")
    leaves = scratch.write(lines.groupBy("leaf").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                           .filter("lo != hi").select("leaf"), "leaves")
    blank = F.col("m") != ""
    spans = [F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("c")]
    own = scratch.write(line_rows(docs).select("doc", "leaf", "n", "m").join(leaves, "leaf")
                        .groupBy("leaf", "n", "m").agg(*spans).filter(blank), "own")
    # constants: (leaf, place, token) in two different masked lines
    wide = own.filter(F.col("n") >= MIN_GENERAL)
    crowded = wide.groupBy("leaf").agg(F.count("*").alias("k")).filter("k > 1").select("leaf")
    wide = wide.join(crowded, "leaf", "left_semi").withColumn("line_key", F.xxhash64("m"))
    tokens = wide.select("leaf", "line_key", "n", F.posexplode(F.split("m", " ")).alias("at", "token"))
    often = tokens.groupBy("leaf", "at", "token").agg(F.count("*").alias("k")).filter("k > 1").drop("k")
    kept = tokens.join(often, ["leaf", "at", "token"])
    shape = (kept.groupBy("leaf", "line_key", "n")
             .agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("constants")))
    general = (shape.filter(F.size(F.filter("constants", lambda c: c["at"] >= DEPTH)) >= SIMILARITY * (F.col("n") - DEPTH))
               .select("leaf", "line_key", F.xxhash64("n", "constants").alias("general")))
    templates = (own.withColumn("line_key", F.xxhash64("m")).join(general, ["leaf", "line_key"], "left")
                 .select("leaf", "line_key", "n", "lo", "hi", "c", F.coalesce("general", "line_key").alias("template")))
    templates = scratch.write(templates, "templates")
    found = (templates.groupBy("leaf", "template")
             .agg(F.min("lo").alias("first"), F.max("hi").alias("hi"), F.sum("c").alias("c"), F.min("n").alias("n"))
             .filter((F.col("first") != F.col("hi")) & ((F.col("n") >= MIN_TOKENS) | (F.col("c") >= MIN_SHORT)))
             .select("leaf", "template", "first"))
    return lines, templates.join(found, ["leaf", "template"]).select("leaf", "line_key", "first")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(doc, text_key, text) -> (doc, text_key, n, shingles): hashes of the distinct sequences of SHINGLE words (the whole
    text, if it has fewer); texts without words are left out."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # the explode keeps the words from being split again for each sequence
    d = texts.select("doc", "text_key", F.explode(F.array(words)).alias("w")).filter(F.size("w") > 0)
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (SHINGLE - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, SHINGLE)))
    d = d.select("doc", "text_key", F.explode(F.array(F.array_distinct(each))).alias("shingles"))
    return d.select("doc", "text_key", F.size("shingles").alias("n"), "shingles")


def near_firsts(docs: DataFrame, hits: DataFrame, scratch: Scratch, percent: int = 75) -> DataFrame:
    """(doc, text_key, first): of the ``hits``, the documents that are near copies (five-word shingles, ``percent``) of
    the document that keeps their line, by comparing the whole sets of each such pair.  Sizes of sets rule out most
    pairs before any set is kept."""
    pairs = scratch.write(hits.select("doc", "text_key", "first").distinct(), "pairs")
    texts = docs.filter("text is not null").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), text_key("text").alias("text_key"), "text")
    sizes = scratch.write(shingle_sets(texts).select("doc", "text_key", "n").dropDuplicates(["doc", "text_key"]), "sizes")
    other = sizes.select(F.col("doc").alias("first"), F.col("text_key").alias("first_key"), F.col("n").alias("m"))
    like = pairs.join(sizes, ["doc", "text_key"]).join(other, "first").filter(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
    like = scratch.write(like, "like")
    scratch.drop("sizes", "pairs")
    wanted = like.select("doc", "text_key").unionByName(like.select(F.col("first").alias("doc"), F.col("first_key").alias("text_key"))).distinct()
    sets = scratch.write(shingle_sets(texts.join(wanted, ["doc", "text_key"], "left_semi").dropDuplicates(["doc", "text_key"])).drop("n"), "sets")
    used = like.groupBy("first", "first_key").agg(F.count("*").alias("rows"))
    kept = sets.select(F.col("doc").alias("first"), F.col("text_key").alias("first_key"), F.col("shingles").alias("others")).join(used, ["first", "first_key"])
    met = join_keyed(like, scratch.write(kept, "kept"), ["first", "first_key"], "rows").join(sets, ["doc", "text_key"])
    same = F.size(F.array_intersect("shingles", "others"))
    near = scratch.write(met.filter(same * 100 >= (F.col("n") + F.col("m") - same) * percent).select("doc", "text_key", "first").distinct(), "near")
    scratch.drop("sets", "kept", "like")
    return near


def drop_recurring(docs: DataFrame, count_col: str | None = None, spare_copies: bool = False) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``; ``count_col`` gets their number.

    With ``spare_copies`` a line stays where the document is a near copy of the one that keeps the line: near
    copies go as wholes in a near-duplicate stage, which finds them only if they still are near copies.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines, found = recurring(docs, scratch)
    hits = lines.join(found, ["leaf", "line_key"]).filter(F.col("doc") != F.col("first"))
    if spare_copies:
        hits = scratch.write(hits.select("doc", "text_key", "pos", "n", "first"), "hits")
        scratch.drop("lines", "leaves", "own", "templates")  # the hits are all that is needed of them
        hits = hits.join(near_firsts(docs, hits, scratch), ["doc", "text_key", "first"], "left_anti")
    gone = (hits.groupBy(F.col("doc").alias("__doc"), F.col("text_key").alias("__key")).agg(F.collect_set(F.struct("pos", "n")).alias("__gone")))
    joined = docs.join(gone, (F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID)) == F.col("__doc"))
                       & (text_key(docs["text"]) == F.col("__key")), "left")
    drop = F.col("__gone").isNotNull()
    parts = F.split(docs["text"], "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.transform("__gone", lambda x: x["pos"]))
    text = F.when(drop, F.array_join(F.transform(F.array_sort(stay), lambda i: F.get(parts, i)), "\n")).otherwise(docs["text"])
    cols = [text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    if count_col:
        cols.append(F.when(drop, F.size("__gone")).otherwise(0).alias(count_col))
    return joined.select(*cols)


def op5(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_recurring(docs, "dropped_lines")
    return out.select("doc_id", F.col("dropped_lines").cast("long").alias("dropped_lines"),
                      F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


#: The same rules in DuckDB: constants and templates as token lists.
ORACLE = f"""
WITH raw AS (SELECT DISTINCT coalesce(doc_id, {LAST_ID}) AS doc, text FROM documents WHERE text IS NOT NULL),
ex AS (SELECT doc, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM raw),
pl AS (SELECT doc, text, pos, trim(regexp_replace(line, '[ \\t\\r\\f\\x0B]+', ' ', 'g')) AS p FROM ex),
mk AS (SELECT *, string_split(regexp_replace(p, '[^ ]*[0-9][^ ]*', '{MASK}', 'g'), ' ') AS mt FROM pl WHERE p <> ''),
l AS (SELECT doc, text, pos, CASE WHEN len(list_filter(mt, lambda x: x = '{MASK}')) <= {1 - SIMILARITY} * len(mt) THEN mt
      ELSE string_split(p, ' ') END AS t FROM mk),
lf AS (SELECT *, len(t) AS n, t[1:{DEPTH}] AS head FROM l),
own AS (SELECT n, head, t, min(doc) AS lo, max(doc) AS hi, count(*) AS c FROM lf GROUP BY ALL),
tk AS (SELECT n, head, t, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM own WHERE n >= {MIN_GENERAL}),
often AS (SELECT n, head, place, token FROM tk GROUP BY ALL HAVING count(*) > 1),
shape AS (SELECT n, head, t, list((place, token) ORDER BY place) AS k, count(*) FILTER (WHERE place > {DEPTH}) AS tail
          FROM tk JOIN often USING (n, head, place, token) GROUP BY ALL),
tpl AS (SELECT o.*, CASE WHEN s.tail >= {SIMILARITY} * (o.n - {DEPTH}) THEN CAST(s.k AS VARCHAR) ELSE 'line ' || CAST(o.t AS VARCHAR) END AS template
        FROM own o LEFT JOIN shape s USING (n, head, t)),
rec AS (SELECT n, head, template, min(lo) AS first FROM tpl GROUP BY ALL
        HAVING min(lo) <> max(hi) AND (n >= {MIN_TOKENS} OR sum(c) >= {MIN_SHORT})),
gone AS (SELECT lf.doc, lf.text, lf.pos FROM lf JOIN tpl USING (n, head, t) JOIN rec USING (n, head, template) WHERE lf.doc <> rec.first),
g AS (SELECT doc, text, list(pos) AS p FROM gone GROUP BY ALL),
fin AS (SELECT d.doc_id, g.p, CASE WHEN g.p IS NULL THEN d.text ELSE array_to_string(list_filter(string_split(d.text, chr(10)),
        lambda x, i: NOT list_contains(g.p, i)), chr(10)) END AS text
        FROM documents d LEFT JOIN g ON coalesce(d.doc_id, {LAST_ID}) = g.doc AND d.text = g.text)
SELECT doc_id, coalesce(len(p), 0) AS dropped_lines, coalesce(length(text), 0) AS kept_chars, md5(text) AS text_md5 FROM fin
"""
