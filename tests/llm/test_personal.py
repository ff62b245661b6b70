"""Operator 11 against plain Python: base forms, the pattern-instance graph, added spans, awkward rows."""

import collections
import hashlib
import random
import re

import pytest

from hirelens.llm import personal
from hirelens.llm.common import Scratch, join_keyed

#: The base forms as the contract states them.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SPACE = " \t\n\x0b\f\r"


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def base_spans(text):
    return [(k, m.start(), m.end(), m.group(0)) for k, rx in PLAIN.items() for m in re.finditer(rx, text) if passes(k, m.group(0))]


def nearest(part, before):
    part = part[-64:] if before else part[:64]
    words = [re.sub("[0-9]+", "0", (w[-32:] if before else w[:32])) for w in re.findall(f"[^{SPACE}]+", part.lower())]
    return ((words[::-1] if before else words) + ["^", "^"])[:2]


def contexts(text, rx, keep):
    """(start, end, value, patterns); the text beside a match ends at the next match of the form."""
    ms = list(re.finditer(rx, text))
    for i, m in enumerate(ms):
        b = nearest(text[ms[i - 1].end() if i else 0:m.start()], True)
        a = nearest(text[m.end():ms[i + 1].start() if i + 1 < len(ms) else len(text)], False)
        if keep(m.group(0)):
            yield m.start(), m.end(), m.group(0), [("b", b[0]), ("bb", b[0], b[1]), ("ba", b[0], a[0]), ("aa", a[0], a[1])]


def brute(docs):
    """doc_id -> (base, added), by loops over dictionaries."""
    kinds = personal.KINDS
    forms = {**PLAIN, "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])"}
    edges, cands = collections.defaultdict(set), []
    for doc, text in docs:
        base = base_spans(text)
        for k in kinds:
            for _, _, v, ps in contexts(text, forms[k], lambda v, k=k: passes(k, v)):
                for p in ps:
                    edges[p].add((k, v.lower()))
        for s, e, v, ps in contexts(text, personal.CANDIDATE, lambda v: True):
            v = re.sub(r"[\W_]+$", "", v)
            e = s + len(v)
            if ("@" in v or len(re.findall("[0-9]", v)) >= personal.MIN_DIGITS) and not any(b[1] < e and b[2] > s for b in base):
                cands.append((doc, s, e, v, ps))
                for p in ps:
                    edges[p].add((None, v.lower()))
    score, conf = collections.defaultdict(dict), {}
    for _ in range(personal.ROUNDS):
        conf = {}
        for p, vs in edges.items():
            open_ = [v for k, v in vs if k is None]
            seeds = {k: sum(x == k for x, _ in vs) for k in kinds}
            got = {k: seeds[k] * 10**6 + sum(score[v].get(k, 0) for v in open_) for k in kinds}
            unknown = len(open_) * 10**6 - sum(score[v].get(k, 0) for v in open_ for k in kinds)
            for k in kinds:
                c = 2 * got[k] * 10**6 // (2 * sum(got.values()) + max(unknown, 0) + 2 * personal.PRIOR * 10**6)
                if seeds[k] >= personal.MIN_SEEDS and c >= personal.ACCEPT:
                    conf[p, k] = c
        score = collections.defaultdict(dict)
        for (p, k), c in conf.items():
            for kind, v in edges[p]:
                if kind is None:
                    score[v][k] = max(score[v].get(k, 0), c)
    out = {doc: (base_spans(text), []) for doc, text in docs}
    for doc, s, e, v, ps in cands:
        best = max(((c, -kinds.index(k)) for p in ps for k in kinds if (c := conf.get((p, k)))), default=None)
        if best:
            out[doc][1].append((kinds[-best[1]], s, e, v))
    return {d: (b, sorted(a, key=lambda x: (kinds.index(x[0]), x[1]))) for d, (b, a) in out.items()}


def planted(n=60):
    rng = random.Random(11)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    docs = []
    for i in range(n):
        docs.append((i, f"{say(8)} call me on +1 ({num(3)}) 555-{num(4)} today {say(5)}\nmail to: u{num(3)}@mail.example.com, {say(4)}"
                        f" the host is 10.{i}.3.{rng.randrange(256)} now. version 3.{num(4)} {say(3)} +1 ({num(3)}) 555-{num(4)} {say(2)}"))
    for i in range(n, n + 12):
        docs.append((i, f"{say(8)} call me on {num(4)} {num(3)} {num(3)} today {say(5)}\nmail to: u{num(3)}@localhost, {say(6)} release {num(6)} is out"))
    docs.append((900, f"{say(30)} paid {num(7)} by hand. Nothing else 123456 here"))
    return docs


def test_forms_and_tests_of_matches(spark):
    text = ("a@b.cc_d@e.ff x@y @z.zz q@-.. 1.2.3.4.5.6.7.8 256.1.1.1 0255.01.001.0 4111 1111 1111 1111 4111-1111-1111-1112 "
            "4111111111111111 2 41111111111111110000 +1 (017) 555-7713 rest +1234567 +1-2-3-4-5-6-7-8. é𝒳 +44 20 7946 0958\n1..2 "
            + "9" * 5000 + " " + "1 " * 4000 + "a." * 3000 + "@" + "b." * 3000 + "c ") * 2
    rows = [(1, text), (2, None), (3, ""), (4, "𝒳𝒳 me@x.org"), (None, "me@x.org"), (None, None)]
    got = {r.doc_id: [(b.kind, b.start, b.end, b.text) for b in r.base]
           for r in personal.find(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id is not None}
    assert got == {i: base_spans(t or "") for i, t in rows if i is not None}
    assert len(got[1]) > 15


def test_bootstrapping_equals_the_loops(spark):
    docs = planted()
    got = {r.doc_id: ([tuple(b) for b in r.base], [tuple(a) for a in r.added])
           for r in personal.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute(docs)
    assert got == want
    added = [k for _, a in want.values() for k in a]
    assert sum(k[0] == "phone" for k in added) >= 12 and sum(k[0] == "email" for k in added) >= 12
    assert not want[900][1] and not any("version" in docs[d][1][max(0, s - 9):s] for d in range(60) for _, s, _, _ in want[d][1])


def test_copies_add_no_confidence(spark):
    """A hundred copies of one text are one value a pattern; nothing is learned from them."""
    docs = [(i, "please ring +1 (017) 555-7713 now") for i in range(100)] + [(200, "please ring 0175 557 713 now")]
    out = personal.find(spark.createDataFrame(docs, "doc_id long, text string"))
    assert out.count() == 101 and out.filter("size(added) > 0").count() == 0


def test_awkward_rows(spark):
    schema = "doc_id long, text string, pattern string, value long, kind string, n int, c string, x string"
    row = lambda i, t: (i, t, "p", 1, "k", 2, "c", "x")
    some = "mail to: me@example.com, or 8.8.8.8"
    rows = [row(1, some), row(1, some), row(None, some), row(None, None), row(2, ""), (3, some) + (None,) * 6, row(4, "word " * 50_000 + some)]
    out = personal.find(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == len(rows)
    assert sorted(len(r.base) for r in out) == [0, 0, 2, 2, 2, 2, 2]
    assert personal.find(spark.createDataFrame([], schema)).count() == 0


def test_join_keyed_is_a_join(spark):
    rows = [("hot", i) for i in range(2000)] + [(f"k{i % 900}", i) for i in range(1800)]
    r = Scratch(spark, "t").write(spark.createDataFrame(rows, "k string, v long"), "r")
    keyed = Scratch(spark, "t").write(r.filter("k != 'k7'").groupBy("k").count().withColumnRenamed("count", "n"), "k")
    got = sorted((x.k, x.v) for x in join_keyed(r, keyed, ["k"], "n").collect())
    assert got == sorted((k, v) for k, v in rows if k != "k7")


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    out = {r.doc_id: r for r in personal.op11(spark, sf).collect()}
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(docs)
    order = {k: i for i, k in enumerate(personal.KINDS)}
    for d, _ in docs:
        base, added = want[d]
        listed = lambda xs: ",".join(f"{k}:{s}:{e}" for k, s, e, _ in xs)
        assert out[d].base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert out[d].spans == listed(sorted(base + added, key=lambda x: (order[x[0]], x[1], x[2])))
        assert [out[d][f"n_{k}"] for k in personal.KINDS] == [sum(b[0] == k for b in base) for k in personal.KINDS]
    assert len(out) == len(docs) and pytest.approx(sum(r.n_added for r in out.values())) == sum(len(a) for _, a in want.values())
