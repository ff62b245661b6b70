"""Operator 11, personal data by bootstrapped contextual extraction.  DataFrame functions only.

Seeds are the spans of four fixed forms (email, ip, card, phone).  A seed's lexical patterns are
the words around it: the word before, the two words before, the word on either side, the two words
after (lower case, digits masked, by the 32 characters next to the span).  Candidates are other
tokens that hold a digit or an at sign (at least ``MIN_DIGITS`` digits or an at sign), groups of
digits that follow taken along; they have patterns of the same forms.

The graph has an edge between a pattern and each distinct value it surrounds.  A seed counts 1 for
its kind; a candidate counts, for each kind, the confidence of its best accepted pattern of the
round before.  A pattern's confidence for a kind is the counts of that kind against the counts of
all kinds, half of what candidates leave open, and ``PRIOR``.  After ``ROUNDS`` rounds, patterns
with ``MIN_SEEDS`` different seeds of the kind and a confidence of ``ACCEPT`` add the candidates they
surround, with the kind of the most confident one (ties: the kind listed first).  Copies of a text
add nothing, since values count once a pattern.  Scores are whole millionths, so that no order of
summing changes a result.

All counting combines before the shuffle; patterns and values that hold more than ``1/HOT_PARTS`` of
the edges are joined by broadcast (at most ``HOT_PARTS`` of them), the rest by shuffle.  Each text is
read once; what is written is one row per document with its spans and pattern hashes.

Defined results: a null or empty text has no spans; positions are code points, ends exclusive;
rows of equal doc_id and text (null ids too) get equal results; ties are decided as above; long
texts are searched whole, every pattern starts at most once per run of its characters; an empty
table gives no rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, join_keyed, table, text_key

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")

LOCAL = "[A-Za-z0-9._%+-]"
#: The base forms.  ``\G`` or the lookbehind starts a form once per run of characters (the leftmost
#: start), possessive repeats keep long texts linear; the matches are those of the plain forms.
#: Cards are matched as whole runs of 16 to 19 digits, other runs fail in any case.
FORMS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap test that every text with a match passes.
QUICK = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "(?:[0-9][ -]?){16}", "phone": r"\+[0-9]"}

TOKEN = r"[^\x20\x09-\x0D=:\"'<>|,;!?\[\]{}]"
PLAIN = r"[^\x20\x09-\x0D=:\"'<>|,;!?\[\]{}0-9@]"
CANDIDATE = rf"(?<!{TOKEN}){PLAIN}*+[0-9@]{TOKEN}*+(?: \(?[0-9-]{{1,9}}+\)?+(?!{TOKEN}))*+"
TAIL = r"[^\p{L}\p{N}]+$"
WORD = r"[^\x20\x09-\x0D]+"
NEAR = 64

MIN_DIGITS = 4
MIN_SEEDS = 5
PRIOR = 3
ACCEPT = 700_000
ONE = 1_000_000
ROUNDS = 3


def passes(kind: str, value: Column) -> Column:
    """The test of a match: parts of an address, Luhn's sum, number of digits."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        def add(s, i):
            x = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
            return s + F.when(i % 2 == 1, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0))
        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def cut(text: Column, form: str, quick: str) -> Column:
    """Struct of the matches of ``form`` and the parts between them, one part more than matches."""
    hit = text.rlike(quick)
    none = F.lit(None).cast("array<string>")
    return F.struct(F.when(hit, F.regexp_extract_all(text, F.lit(form), F.lit(0))).otherwise(none).alias("found"),
                    F.when(hit, F.split(text, form, -1)).otherwise(none).alias("parts"))


def words_by(part: Column, before: bool) -> Column:
    """The words of the NEAR characters next to a span, nearest first; one that has none: ``^``."""
    near = F.substring(part, -NEAR, NEAR) if before else F.substring(part, 1, NEAR)
    words = F.transform(F.regexp_extract_all(F.lower(near), F.lit(WORD), F.lit(0)),
                        lambda w: F.regexp_replace(F.substring(w, -32, 32) if before else F.substring(w, 1, 32), "[0-9]+", "0"))
    return F.concat(F.reverse(words) if before else words, F.array(F.lit("^"), F.lit("^")))


def spans(cutting: Column) -> Column:
    """Array of start, end, value, before, after (the nearest two words on either side)."""
    found, parts = cutting["found"], cutting["parts"]
    sizes = F.arrays_zip(F.transform(parts, F.length).alias("gap"), F.transform(found, F.length).alias("n"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(sizes, empty, lambda s, x: F.struct((s["at"] + x["gap"] + F.coalesce(x["n"], F.lit(0))).alias("at"),
                         F.concat(s["starts"], F.array(s["at"] + x["gap"])).alias("starts")))["starts"]
    before = F.transform(parts, lambda p: F.slice(words_by(p, True), 1, 2))
    after = F.transform(F.slice(parts, 2, F.greatest(F.size(found), F.lit(0))), lambda p: F.slice(words_by(p, False), 1, 2))
    zipped = F.arrays_zip(starts.alias("s"), found.alias("v"), before.alias("b"), after.alias("a"))
    out = F.transform(F.filter(zipped, lambda z: z["v"].isNotNull()), lambda z: F.struct(
        z["s"].alias("start"), (z["s"] + F.length(z["v"])).alias("end"), z["v"].alias("value"), z["b"].alias("before"), z["a"].alias("after")))
    return F.coalesce(out, F.array().cast("array<struct<start:int,end:int,value:string,before:array<string>,after:array<string>>>"))


def patterns(x: Column) -> Column:
    """Hashes of the four lexical patterns of an occurrence."""
    b, a = x["before"], x["after"]
    return F.array(F.xxhash64(F.lit("b"), b[0]), F.xxhash64(F.lit("bb"), b[0], b[1]),
                   F.xxhash64(F.lit("ba"), b[0], a[0]), F.xxhash64(F.lit("aa"), a[0], a[1]))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and candidates (arrays of kind, start, end, text, patterns; kind -1: candidate).

    One row per row of ``docs``.  The one-element explodes keep what several columns use from being
    computed once for each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cuts = [cut(F.col("t"), FORMS[k], QUICK[k]).alias(k) for k in KINDS] + [cut(F.col("t"), CANDIDATE, "[0-9@]").alias("other")]
    d = docs.select("doc_id", text_key("text").alias("text_key"), text.alias("t"))
    d = d.select("doc_id", "text_key", F.explode(F.array(F.struct(*cuts))).alias("c"))

    def shaped(kind, x):
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                        x["value"].alias("text"), patterns(x).alias("patterns"))

    def trimmed(x):
        value = F.regexp_replace(x["value"], TAIL, "")
        return F.struct(F.lit(-1).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(value)).alias("end"),
                        value.alias("text"), patterns(x).alias("patterns"))

    def seeds(i, kind):
        return F.transform(F.filter(spans(F.col("c")[kind]), lambda x: passes(kind, x["value"])), lambda x: shaped(i, x))
    base = F.concat(*[seeds(i, k) for i, k in enumerate(KINDS)])
    d = d.select("doc_id", "text_key", F.explode(F.array(F.struct(base.alias("base"), F.transform(spans(F.col("c")["other"]), trimmed).alias("other")))).alias("x"))
    base = F.col("x")["base"]
    free = F.filter(F.col("x")["other"], lambda c: (c["text"].contains("@") | (F.length(F.regexp_replace(c["text"], "[^0-9]", "")) >= MIN_DIGITS))
                    & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"])))
    return d.select("doc_id", "text_key", base.alias("base"), free.alias("candidates"))


def accepted_patterns(found: DataFrame, scratch: Scratch) -> DataFrame:
    """pattern, kind, confidence (millionths), n (edges to candidates): the pattern-instance graph, scored."""
    n = len(KINDS)
    each = found.select(F.explode(F.concat("base", "candidates")).alias("x"))
    edges = (each.select(F.explode("x.patterns").alias("pattern"), "x.kind", F.xxhash64(F.lower("x.text")).alias("value"))
             .distinct())
    # only patterns with enough seeds of a kind can ever be accepted; the others need no scores
    seeds = [F.count(F.when(F.col("kind") == k, 1)).alias(f"seeds{k}") for k in range(n)]
    edges = scratch.write(edges, "edges")
    pats = edges.groupBy("pattern").agg(*seeds, F.count(F.when(F.col("kind") < 0, 1)).alias("n"))
    pats = pats.filter(F.greatest(*[f"seeds{k}" for k in range(n)]) >= MIN_SEEDS)
    pats = scratch.write(pats, "patterns")
    open_edges = join_keyed(edges.filter("kind < 0").select("pattern", "value"), pats.filter("n > 0").select("pattern", "n"), ["pattern"], "n")
    open_edges = scratch.write(open_edges.select("pattern", "value"), "open")
    scratch.drop("edges")

    def confidence(sums: DataFrame | None) -> DataFrame:
        """Per pattern its confidences conf0..; ``sums``: what its candidates count for each kind."""
        p = pats
        if sums is not None:
            p = p.join(sums, "pattern", "left")
        got = [F.col(f"seeds{k}") * ONE + (F.coalesce(F.col(f"s{k}"), F.lit(0)) if sums is not None else F.lit(0)) for k in range(n)]
        all_of = sum(got[1:], got[0])
        unknown = F.col("n") * ONE - (sum([F.coalesce(F.col(f"s{k}"), F.lit(0)) for k in range(n)], F.lit(0)) if sums is not None else F.lit(0))
        whole = 2 * all_of + F.greatest(unknown, F.lit(0)) + 2 * PRIOR * ONE
        conf = [F.when(F.col(f"seeds{k}") >= MIN_SEEDS, F.floor(2 * got[k] / whole * ONE)).otherwise(0).cast("long") for k in range(n)]
        return p.select("pattern", "n", *[F.when(c >= ACCEPT, c).otherwise(0).alias(f"conf{k}") for k, c in enumerate(conf)])

    conf = confidence(None)
    for i in range(1, ROUNDS):
        good = conf.filter((F.col("n") > 0) & (F.greatest(*[f"conf{k}" for k in range(n)]) > 0))
        # a candidate's count: its best pattern, for each kind; written, since the next round reads it twice
        values = join_keyed(open_edges, good, ["pattern"], "n").groupBy("value").agg(*[F.max(f"conf{k}").alias(f"s{k}") for k in range(n)])
        degree = open_edges.groupBy("value").agg(F.count("*").alias("n"))
        values = scratch.write(values.join(degree, "value"), f"values-{i}")
        sums = join_keyed(open_edges, values, ["value"], "n").groupBy("pattern").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(n)])
        conf = scratch.write(confidence(sums), f"confidence-{i}")
        scratch.drop(f"values-{i}", *([f"confidence-{i - 1}"] if i > 1 else []))
    best = F.array_max(F.array(*[F.struct(F.col(f"conf{k}").alias("confidence"), F.lit(-k).alias("order")) for k in range(n)]))
    return (conf.filter(F.col("n") > 0).select("pattern", "n", best.alias("b")).filter(F.col("b.confidence") > 0)
            .select("pattern", (-F.col("b.order")).alias("kind"), F.col("b.confidence").alias("confidence"), "n"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and added: arrays of (kind, start, end, text) by kind, then start."""
    scratch = Scratch(docs.sparkSession, "personal")
    found = scratch.write(occurrences(docs), "found")
    good = scratch.write(accepted_patterns(found, scratch), "accepted")
    # candidates of one pattern with a count, so that a pattern around a third of them is known as hot
    rows = found.filter(F.size("candidates") > 0).select("doc_id", "text_key", F.explode("candidates").alias("c"))
    rows = rows.select("doc_id", "text_key", "c.start", "c.end", "c.text", F.explode("c.patterns").alias("pattern"))
    hits = rows.groupBy("pattern").agg(F.count("*").alias("rows")).join(good, "pattern")
    hits = scratch.write(hits.select("pattern", "kind", "confidence", "rows"), "hits")
    named = join_keyed(rows, hits, ["pattern"], "rows")
    one = (named.groupBy("doc_id", "text_key", "start", "end", "text")
           .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("order"))).alias("b"))
           .select("doc_id", "text_key", F.struct((-F.col("b.order")).alias("kind"), "start", "end", "text").alias("x")))
    added = one.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.array_sort(F.collect_list("x")).alias("added"))
    slim = F.transform("base", lambda b: F.struct(b["kind"], b["start"], b["end"], b["text"]))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,text:string>>")
    plain = found.filter(F.size("candidates") == 0).select("doc_id", "text_key", slim.alias("base"), none.alias("added"))
    rest = found.filter(F.size("candidates") > 0).select("doc_id", "text_key", slim.alias("base"))
    rest = rest.join(added, rest["doc_id"].eqNullSafe(F.col("__id")) & (rest["text_key"] == F.col("__key")), "left")
    rest = rest.select("doc_id", "text_key", "base", F.coalesce("added", none).alias("added"))
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    both = plain.unionByName(rest)
    named = lambda c: F.transform(c, lambda x: F.struct(name(x).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text")))
    return both.select("doc_id", "text_key", named("base").alias("base"), named("added").alias("added"))


def listed(spans_: Column) -> Column:
    """kind:start:end, comma-joined, in the order given."""
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def ordered(spans_: Column) -> Column:
    """By kind as listed, then start, then end."""
    order = F.array(*map(F.lit, KINDS))
    keyed = F.transform(spans_, lambda x: F.struct(F.array_position(order, x["kind"]).alias("k"), x["start"].alias("s"), x["end"].alias("e"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda y: y["x"])


def op11(spark, sf_dir) -> DataFrame:
    out = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in KINDS], F.size("added").cast("long").alias("n_added"),
                      F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      listed(ordered(F.concat("base", "added"))).alias("spans"))
