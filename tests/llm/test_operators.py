"""Each operator against a brute-force version on small inputs."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import (decontam, lines, maxent, minhash, nndescent, pieces, sharding, token_counts, toxicity,
                          urls)
from hirelens.llm.common import Scratch, components, fold_of

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}x" for _ in range(n))


# ---------------------------------------------------------------- shared

def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


# ---------------------------------------------------------------- 1 toxicity

def test_toxicity_learns_and_keeps_the_held_out_fold_out(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(1200):
        toxic = i % 6 == 0
        t = words(rng, 40).split()
        if toxic:
            for _ in range(3):
                t.insert(rng.randrange(len(t)), rng.choice(["zorkish", "zorking", "zorkeln", "plobber"]))
        docs.append((i, " ".join(t)))
        labels.append((i, int(toxic)))
    d, lab = spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, "doc_id long, toxic int")
    # labels of the held-out fold must not matter: turn them round
    fold = {r.doc_id: r.f for r in d.select("doc_id", fold_of("doc_id", 3).alias("f")).collect()}
    assert fold == {i: zlib.crc32(str(i).encode()) % 3 for i in range(1200)}
    wrong = spark.createDataFrame([(i, 1 - y if fold[i] == 1 else y) for i, y in labels], "doc_id long, toxic int")
    out = toxicity.with_score(d, toxicity.fit(d, wrong)).collect()
    truth = dict(labels)
    held = [(truth[r.doc_id], r.score) for r in out if fold[r.doc_id] == 1]
    assert all(0 <= r.score <= 1 for r in out) and len(out) == 1200
    assert sum((s >= 0.7) == bool(y) for y, s in held) / len(held) >= 0.98
    again = toxicity.with_score(d, toxicity.fit(d, lab)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in out}


def test_toxicity_features():
    lex = toxicity.Lexicon(["=blurb", "^snarf"])
    f = dict(zip(toxicity.FEATURES, lex.features("You are a snarfing BLURB!! 1d10t and st.u.pid person")))
    assert f["mined"] == pytest.approx(1 / 9) and f["beginnings"] == pytest.approx(1 / 9)
    assert f["hidden"] == pytest.approx(2 / 9) and f["near_share"] > 0 and f["shouted"] > 0 and f["exclaim"] > 0
    assert not any(lex.features("")) and lex.features("clean text")[1:5] == [0, 0, 0, 0]


# ---------------------------------------------------------------- 2 decontamination

def brute_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def edited(rng, item, k, voc):
    w = list(item)
    for _ in range(k):
        at, kind = rng.randrange(len(w)), rng.random()
        if kind < 0.34:
            w[at] = rng.choice(voc)
        elif kind < 0.67:
            del w[at]
        else:
            w.insert(at, rng.choice(voc))
    return w


def test_decontamination_against_brute_force(spark):
    rng = random.Random(5)
    voc = [f"v{i}" for i in range(300)]
    items = [[rng.choice(voc) for _ in range(rng.randint(6, 45))] for _ in range(25)]
    docs = []
    for i in range(150):
        body = [rng.choice(voc) for _ in range(rng.randint(0, 80))]
        if i % 2:
            it = items[rng.randrange(25)]
            at = rng.randrange(len(body) + 1)
            body[at:at] = edited(rng, it, rng.randint(0, decontam.edits_of(len(it)) + 2), voc)
        docs.append((i, " ".join(body)))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    d = spark.createDataFrame(docs, DOC)
    got = {(r.doc_id, r.item_id): r.edits for r in decontam.matches(d, bench).collect()}
    want = {}
    for i, t in docs:
        for j, it in enumerate(items):
            e = brute_edits(it, decontam.words_of(t))
            if e <= decontam.edits_of(len(it)):
                want[i, j] = e
    assert not set(got) - set(want)
    assert len(set(want) & set(got)) >= 0.95 * len(want) and len(want) > 40
    assert all(got[k] == want[k] for k in got)
    exact = {k for k, e in want.items() if e == 0}
    assert exact <= set(got)
    assert {r.doc_id for r in decontam.clean(d, bench).collect()} == {i for i, _ in docs} - {k[0] for k in got}


def test_decontamination_recall_at_full_distance():
    rng = random.Random(9)
    voc = [f"v{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(15, 60)))) for i in range(60)]
    f = decontam.Finder(items)
    hit = 0
    for i, t in items:
        w = t.split()
        doc = [rng.choice(voc) for _ in range(50)] + edited(rng, w, decontam.edits_of(len(w)), voc) + [rng.choice(voc) for _ in range(50)]
        hit += any(i in f.ids[x[1]] for x in f.find([" ".join(doc)]))
    assert hit >= 0.95 * len(items)


def test_decontamination_in_several_blocks(spark, monkeypatch):
    bench = read(spark, "benchmark")
    docs = read(spark, "documents")
    one = sorted(map(tuple, decontam.matches(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2000)
    assert len(list(decontam.blocks(bench))) > 3
    assert sorted(map(tuple, decontam.matches(docs, bench).collect())) == one and one


# ---------------------------------------------------------------- 3 token counts

def test_rollup_is_idempotent_and_signed(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, op string, n_tokens long, old_tokens long"
    r = token_counts.Rollup(spark, str(tmp_path))
    assert r.totals().count() == 0
    load = spark.createDataFrame([("a", "en", "t1", "insert", 10, None), ("a", "en", "t1", "insert", 5, None),
                                  (None, "en", "t1", "insert", None, None), ("b", None, "t1", "insert", 7, None)], schema)
    assert r.commit("one", load) and not r.commit("one", load)
    assert r.commit("two", spark.createDataFrame([("a", "en", "t1", "delete", 5, None), ("b", None, "t1", "revise", 9, 7),
                                                  ("b", None, "t1", "delete", 9, None)], schema))
    assert not r.commit("two", load) and r.commit("none", load.limit(0))
    again = token_counts.Rollup(spark, str(tmp_path))  # another process
    assert not again.commit("one", load)
    assert sorted(map(tuple, again.totals().collect()), key=str) == [("a", "en", "t1", 1, 10), (None, "en", "t1", 1, 0)]


def test_model_tokenizer_counts(spark):
    docs = read(spark, "documents").select("text").limit(30)
    path = pieces.default_model()
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in docs.select("text", token_counts.count_tokens(F.col("text"), "piece_bpe_32k", path).alias("n")).collect():
        assert r.n == len(sp.encode(r.text))


# ---------------------------------------------------------------- 4 embeddings

def test_nndescent_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 16))
    rows, vid = [], 0
    dense = rng.standard_normal(16)
    for x in [dense + rng.standard_normal(16) * 0.03 for _ in range(90)] + list(base) + [b + rng.standard_normal(16) * 0.08 for b in base[:30]] + list(base[:10] * 3):
        rows.append((vid, [float(v) for v in np.float32(x)], vid % 2 if vid >= 90 else 0))
        vid += 1
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] + [1.0] * 15, 0),
             (904, [None] + [1.0] * 15, 0), (905, rows[0][1], None), (906, rows[0][1], 0), (907, rows[0][1][:8], 0),
             (908, [float("inf")] + [1.0] * 15, 0)]
    rows.append(rows[95])
    got = nndescent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    out = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect())
    ok = [i for i, (v, e, lab) in enumerate(rows) if lab is not None and e and len(e) == 16 and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    links = collections.defaultdict(set)
    for a in ok:
        for b in ok:
            x, y = np.array(rows[a][1]), np.array(rows[b][1])
            if a != b and rows[a][2] == rows[b][2] and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[a].add(b)
    want = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        c = min(rows[i][0] for i in seen)
        want.append((rows[a][0], len(links[a]), c, rows[a][0] == c))
    assert out == sorted(want)
    assert max(w[1] for w in want) > nndescent.K


def linked(vectors):
    """(links, component) of each row by brute force."""
    u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = u @ u.T >= 0.98
    comp = np.arange(len(u))
    while True:
        new = np.where(hit, comp[None, :], len(u)).min(axis=1)
        if (new == comp).all():
            return list(zip((hit.sum(axis=1) - 1).tolist(), comp.tolist()))
        comp = new


def clusters(centres, each, noise, seed):
    rng = np.random.default_rng(seed)
    return np.float32(np.concatenate([c + rng.standard_normal((each, len(c))) * noise / len(c) ** 0.5 for c in centres])).astype(float)


def near_dup(spark, x):
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    got = nndescent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert len(got) == len(x)
    return [(r.n_links, r.component_id) for r in sorted(got, key=lambda r: r.vec_id)]


def test_dense_groups_meet_each_other(spark, monkeypatch):
    """Two groups nearer within than across, each larger than any list: all cross links count."""
    monkeypatch.setattr(nndescent, "ROUNDS", 2)
    turn = np.arccos(0.99)
    a, far = np.eye(64)[0], np.eye(64)[5]
    x = clusters([a, a * np.cos(turn) + np.eye(64)[1] * np.sin(turn), far], 300, 0.005 ** 0.5, 4)
    want = linked(x)
    assert {c for _, c in want} == {0, 600} and want[0][0] > 400 and want[600][0] < 300
    assert near_dup(spark, x) == want


def test_a_label_below_the_recall_is_compared_in_full(spark, monkeypatch):
    """Descent that finds nothing: the audit must lead to the exact pass."""
    monkeypatch.setattr(nndescent, "ROUNDS", 1)
    monkeypatch.setattr(nndescent, "first_pairs", lambda nodes: nodes.limit(0).selectExpr("node AS a", "node AS b", "CAST(0 AS float) AS s"))
    x = clusters(np.eye(32)[:20], 3, 0.08, 5)
    want = linked(x)
    assert sum(n for n, _ in want) > 60
    assert near_dup(spark, x) == want


# ---------------------------------------------------------------- 5 lines

def test_lines_templates(spark):
    own = "\n{0}a {0}b {0}c is {0}d and {0}e {0}f here {0}g"
    rows = [(i, f"user u{i} logged in from host h{i} at noon today\nshared words of a footer line that is long" + own.format("abcdefgh"[i] * 3)) for i in range(4)]
    rows += [(10, "one two three four five six seven eight nine ten"), (11, "one two three four five six seven eight nine zehn"),
             (12, "one two three vier fuenf sechs sieben acht neun zehnte"), (13, None), (14, ""), (15, "\n\n")]
    rows += [(20 + i, f"ok then\nbody {'xyzuvwrstq'[i] * 4} text number {'xyzuvwrstq'[i] * 2}") for i in range(9)]
    got = {r.doc_id: r.text for r in lines.drop_recurring(spark.createDataFrame(rows, DOC)).collect()}
    assert got[0] == rows[0][1]
    for i in (1, 2, 3):
        assert got[i] == own.format("abcdefgh"[i] * 3)[1:]
    assert got[10] == rows[4][1] and got[11] == "" and got[12] == rows[6][1]  # ten / zehn: one field of a template
    assert got[13] is None and got[14] == "" and got[15] == "\n\n"
    assert all(got[20 + i] == rows[10 + i][1] for i in range(9))  # a short line in nine documents stays


def test_pipeline_drops_a_passage_from_short_texts(spark):
    """No document is left whole for its share of recurring words; only near copies are left to the next stage."""
    import corpus_pipeline

    rng = random.Random(12)
    passage, own = words(rng, 60, 5000), [words(rng, 25, 5000) for _ in range(6)]
    rows = [(i, f"{own[i]}\n{passage}") for i in range(6)]
    long = "\n".join(words(rng, 20, 5000) for _ in range(8))
    rows += [(10, f"{long}\n{passage}"), (11, f"{long}\n{passage}\nand more"), (12, f"{long}\n{passage}")]
    docs = spark.createDataFrame(rows, DOC)
    out = corpus_pipeline.drop_lines(spark, docs, SF)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {0: rows[0][1], **{i: own[i] for i in range(1, 6)}, 10: long, 11: f"{long}\nand more", 12: long}
    kept = corpus_pipeline.drop_near_duplicates(spark, Scratch(spark, "t").write(out, "docs"), SF)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(6), 10]


def test_near_copies_are_proven_by_whole_sets(spark):
    """Pairs of a document and the one that keeps its line: exactly those of similarity 0.75 or more, without Python."""
    rng = random.Random(21)
    shared_line = words(rng, 12, 5000)
    rows = []
    for g in range(6):
        base = words(rng, 80, 5000).split()
        for k in range(6):
            w = list(base)
            for at in rng.sample(range(80), k):
                w[at] = f"new{g}x{k}y{at}"
            rows.append((10 * g + k, shared_line + "\n" + " ".join(w).replace(" ", "\t", 1) + ("" if k % 2 else "\n" + " ".join(base[:3]).upper())))
    rows += [(100, shared_line), (101, shared_line + "\n" + shared_line), (102, None), (103, "")]
    docs = spark.createDataFrame(rows, DOC)
    hits = spark.createDataFrame([(a, b) for a, t in rows for b, _ in rows if a != b and t is not None and b not in (102, 103)], "doc long, first long")
    keys = docs.selectExpr("doc_id AS doc", "xxhash64(text, text IS NULL) AS text_key")
    out = lines.near_firsts(docs, hits.join(keys, "doc"), Scratch(spark, "t"))
    sets = {i: shingles(t) for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert {(r.doc, r.first) for r in out.collect()} == want and 20 < len(want) < 36 * 35
    plan = lines.drop_recurring(docs, spare_copies=True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_long_passage_stays_once(spark):
    rng = random.Random(8)
    passage = words(rng, 60, 5000)
    rows = [(i, words(rng, 30, 5000) + "\n" + passage + "\n" + words(rng, 30, 5000)) for i in range(30)]
    got = lines.drop_recurring(spark.createDataFrame(rows, DOC)).collect()
    with_it = [r.doc_id for r in got if passage in r.text]
    assert with_it == [0] and [r.text for r in got if r.doc_id == 7] == [rows[7][1].replace(passage + "\n", "")] and all(len(r.text.split()) == 60 for r in got if r.doc_id)


# ---------------------------------------------------------------- 6 MinHash

def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    sets = [shingles(t) for _, t in rows]
    groups = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                old, new = groups[i], groups[j]
                groups = [new if g == old else g for g in groups]
    least = {}
    for g, (d, _) in zip(groups, rows):
        least[g] = min(d, least.get(g, d))
    return [(d, len(s), least[g], least[g] == d) for (d, _), s, g in zip(rows, sets, groups)]


def test_minhash_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randint(0, 60))) for i in range(120)]
    base = words(rng, 120).split()
    for i in range(160):  # a drifting group: many pairs, not all of them linked
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(120)] = f"e{rng.randrange(10 ** 6)}"
        rows.append((200 + i, " ".join(w)))
        if i % 20 == 0:
            base = list(w)
    rows += [(500 + i, t.upper().replace(" ", "\t\n")) for i, (_, t) in enumerate(rows[:40])]
    rows += [(600, "one two"), (601, "ONE  two"), (602, "É é é é é é"), (603, "é é é é é é")]
    rng.shuffle(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(brute_groups(rows))


def test_minhash_estimate_is_close():
    rng = random.Random(1)
    a = words(rng, 400, 10 ** 6).split()
    for share in (0.0, 0.3, 0.6, 0.9):
        b = a[: int(400 * share)] + words(rng, 400 - int(400 * share), 10 ** 6).split()
        p = [minhash.packed_of(minhash.shingle_hashes([x.encode() for x in w])).view(np.uint64) for w in (a, b)]
        off = sum(int(x).bit_count() for x in p[0] ^ p[1])
        x, y = shingles(" ".join(a)), shingles(" ".join(b))
        assert abs(((1 - off / minhash.BITS) - 0.5) / 0.5 - len(x & y) / len(x | y)) < 0.13


# ---------------------------------------------------------------- 7 LM

def test_maxent_base_is_exact_and_model_is_better(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD_WORDS", 500)  # the other words go by the join
    docs = read(spark, "documents")
    got = {r.doc_id: r for r in maxent.score(docs, fold_of("doc_id", 5) == 1).collect()}
    text = {r.doc_id: r.text.encode().lower().split() for r in docs.collect()}
    c, n_texts = collections.Counter(), 0
    for d, w in text.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            c.update(w)
            n_texts += 1
    total, v = sum(c.values()) + n_texts, len(c) + 1
    for d, w in text.items():
        logs = [math.log10((c[x] + 0.5) / (total + 0.5 * (v + 1))) for x in w] + [math.log10((n_texts + 0.5) / (total + 0.5 * (v + 1)))]
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, total)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(sum(logs), rel=1e-9) and r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_maxent_model_is_a_distribution_and_learns():
    rng = np.random.default_rng(0)
    t = maxent.Trainer()
    sizes = np.array([200, 0, 298])
    cls = rng.integers(0, maxent.CLASSES, 501)
    cls[cls == maxent.END] = 0
    cls[[200, 201, 500]] = maxent.END
    key = rng.integers(0, 1 << 60, 501)
    f = maxent.features(sizes, cls, key, 16)
    alone = maxent.features(sizes[2:], cls[202:], key[202:], 16)
    assert (f[:, 202:] == alone).all()  # no history from another text
    for _ in range(20):
        t.step(f, cls)
    p = sum(np.exp(maxent.log_p(t.w, t.bias, f, np.full(501, c))) for c in range(maxent.CLASSES))
    assert np.allclose(p, 1, atol=1e-4)
    assert maxent.log_p(t.w, t.bias, f, cls).mean() > -np.log(maxent.CLASSES) + 0.5
    g = maxent.SINGLES + 2
    counts = maxent.Counts(np.array([5, 9]), np.array([4, 2]), np.array([g, g + 1], np.int32), {g: (6, 2), g + 1: (2, 1)}, 3)
    # singles 0 and 1 took the two head words; one word of 2 tokens is left in the first group
    assert 10 ** counts.log_room[[0, 1, g, maxent.END]] == pytest.approx([5, 3, 3, 4])
    assert counts.total == 6 + 2 + 3 and counts.distinct == 3 + 1


def test_maxent_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    """Several parts and rounds: one file or many partitions, in any order, give the same scores; the rounds learn."""
    monkeypatch.setattr(maxent, "TOKENS_PER_PART", 5000)
    docs = read(spark, "documents").select("doc_id", "text")
    held = fold_of("doc_id", 5) == 1
    one = {r.doc_id: r for r in maxent.score(docs.coalesce(1), held).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    many = {r.doc_id: r for r in maxent.score(docs.repartition(13, F.rand(1)), held).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert maxent.parts_of(one[0].train_tokens) > 2
    assert max(abs(one[d].score - many[d].score) / one[d].n_tokens for d in one) < 1e-6
    gain = lambda got: sum(r.score - r.base_score for r in got.values() if r.held_out) / sum(r.n_tokens for r in got.values() if r.held_out)
    assert gain(one) > 0.03
    monkeypatch.setattr(maxent, "ROUNDS", 1)
    monkeypatch.setattr(maxent, "TOKENS_PER_PART", 500)
    assert gain({r.doc_id: r for r in maxent.score(docs, held).collect()}) < gain(one)


def test_maxent_score_equals_a_plain_scorer(spark):
    """Softmax and word shares over the same weights, by loops over words and classes."""
    docs = read(spark, "documents").select("doc_id", "text")
    held = fold_of("doc_id", 5) == 1
    learnt = docs.filter(~held)
    scratch = Scratch(spark, "t")
    counts, _ = maxent.counts_of(learnt.select("text"), scratch)
    w, bias = maxent.train(learnt, spark.sparkContext.broadcast(counts), counts.total, scratch)
    assert len(w) == 1 << maxent.bits_of(counts.total) == 65536
    head = {int(k): (int(c), int(n)) for k, c, n in zip(counts.keys, counts.cls, counts.n)}
    m64 = (1 << 64) - 1

    def bucket(x):
        x &= m64
        return ((x ^ (x >> 29)) * 0x9E3779B97F4A7C15 & m64) >> 48

    def plain(text):
        total, c1, c2, c3, k1, k2 = 0.0, maxent.CLASSES, maxent.CLASSES, maxent.CLASSES, 0, 0
        for word in [*maxent.words_of(text), None]:
            key = 0 if word is None else maxent.key_of(word)
            cls, n = (maxent.END, counts.n_texts) if word is None else head.get(key, (maxent.group_of(word), 0))
            f = [bucket(k1 + 1), bucket((c1 * 64 + c2) * 4 + 2), bucket((c2 * 64 + c3) * 4 + 3), bucket(k2 + 4)]
            z = [sum(float(w[i][j]) for i in f) + float(bias[j]) for j in range(maxent.CLASSES)]
            total += (z[cls] - math.log(sum(map(math.exp, z)))) / math.log(10) + math.log10(n + 0.5) - counts.log_room[cls]
            c1, c2, c3, k1, k2 = cls, c1, c2, key & m64, k1
        return total
    got = {r.doc_id: r.score for r in maxent.score(docs, held).collect()}
    for r in docs.filter("length(text) < 3000").orderBy("doc_id").limit(12).collect():
        assert got[r.doc_id] == pytest.approx(plain(r.text), rel=1e-4)


def test_maxent_tables_grow_with_the_corpus():
    assert [maxent.bits_of(n) for n in (0, 10, 200_000_000, 200_000_001, 400_000_001, 10 ** 12)] == [16, 16, 16, 17, 18, 20]
    assert [maxent.parts_of(n) for n in (0, 2_000_000, 2_000_001, 10 ** 9)] == [1, 1, 2, 500]


def test_maxent_keeps_its_32_classes():
    words = [f"word{i}".encode() for i in range(30)]
    keys = np.array([maxent.key_of(w) for w in words])
    groups = np.array([maxent.group_of(w) for w in words], np.int32)
    per = {int(g): (int((100 - np.arange(30))[groups == g].sum()), int((groups == g).sum())) for g in set(groups)}
    counts = maxent.Counts(keys, 100 - np.arange(30), groups, per, 1)
    cls = dict(zip(counts.keys, counts.cls))
    assert [cls[k] for k in keys[:11]] == list(range(11)) and all(cls[k] > maxent.END for k in keys[11:])
    assert len({maxent.group_of(bytes([97 + i, 97 + j])) for i in range(26) for j in range(26)}) == 20


def test_maxent_reads_texts_in_runs(monkeypatch):
    texts = ["a b", None, "c" * 50, "", "d e f"]
    monkeypatch.setattr(maxent, "READ_CHARS", 4)
    assert list(maxent.pieces(texts)) == [(0, 2), (2, 3), (3, 4), (4, 5)] and list(maxent.pieces([])) == []


# ---------------------------------------------------------------- 8 urls

def test_whole_urls_are_tokenised(spark):
    """Deep paths, many labels and many query names; rules on them are mined and matched."""
    url = "HTTP://a.b.c.d.e.evil.net/p1/p2/p3/p4/casino12/x.html?a=1&b=2&c=3&d=4&e=5#f"
    d = spark.createDataFrame([(url,), ("http://x",), ("none",), (None,)], "url string")
    rows = d.withColumn("t", urls.tokens_of(F.col("url"), urls.host_of(F.col("url")), urls.path_of(F.col("url")))).collect()
    got = [set(r.t or []) for r in rows]
    assert {"host:evil", "host:a", "tld:net", "path4:casino0", "query:a", "query:e", "ending:html", "fragment"} <= got[0] and got[2] == got[3] == set()
    deep = [(i, f"http://h{i}.a.b.c.d.e.{'bad' if i % 2 else 'good'}.net/1/2/3/4/{'casino' if i % 2 else 'news'}/{i}") for i in range(60)]
    labelled = spark.createDataFrame([(u, "block" if i % 2 else "allow") for i, u in deep], "url string, verdict string")
    pages = spark.createDataFrame([(1, "http://other.org.net/q/w/e/r/casino/9"), (2, "http://other.net/q/w/e/r/news/9"), (3, "http://z.y.x.w.v.bad.net/")], "page_id long, url string")
    out = {r.page_id: r.verdict for r in urls.filter_urls(pages, rules=[("allow", "nowhere.example", "/")], labelled=labelled).collect()}
    assert out[2] == "allow" and "block" in (out[1], out[3])


def test_frequent_tokens_change_no_rule(spark):
    """Rare tokens and twins go; the rest stay."""
    rows = [(f"u{i}", ["a", "b", "c"] if i % 2 else ["a"]) for i in range(40)] + [("u1", ["a", "b", "c"]), ("v", ["rare", "a"])]
    d = spark.createDataFrame(rows, "sample_key string, tokens array<string>")
    got = d.withColumn("t", urls.frequent_tokens(d, 0.1)).select("t").distinct().collect()
    assert {tuple(r.t) for r in got} == {("a", "b"), ("a",)}


def test_list_rules(spark):
    rows = ["http://a.org/x", "https://EXAMPLE.org/es/1?x=http://b.com", "http://www.example.org/en/12", "http://example.org/en/2",
            "http://x.com/fr/1#a", "http://x.com/de/", "http://com/de/x", "http://x.com/dex", "http://a.org", "http://notexample.org/es/",
            "nothing", None, "", "http://x.com:80/de/1", "ftp://u@x.com/de/1/2?q"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in
           urls.filter_urls(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")).collect()}
    assert got[0] == ("a.org", "/x", "org/", "allow")
    assert got[1] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("www.example.org", "/en/12", "example.org/en/1", "block")
    assert got[3][2:] == ("org/", "allow") and got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6][2:] == ("com/de/", "block") and got[7][2] is None and got[8][:3] == ("a.org", "", None)
    assert got[9][2:] == ("org/", "allow")
    for i in (10, 11, 12):
        assert got[i] == ("", "", None, "allow")
    assert got[13][0] == "x.com:80" and got[13][2] is None
    assert got[14][:3] == ("u@x.com", "/de/1/2", "com/de/")


def test_mined_rules_against_brute_force(spark):
    import itertools

    rng = random.Random(6)
    base = []
    for _ in range(300):
        t = sorted({rng.choice("abcde"), rng.choice("fgh"), rng.choice("ij")})
        base.append((t, "block" if {"a", "f"} <= set(t) or "j" in t and rng.random() < 0.85 else "allow", str(rng.random())))
    df = spark.createDataFrame(base, "tokens array<string>, verdict string, sample_key string")
    got = {tuple(r.tokens): (round(r.confidence, 9), round(r.support, 9)) for r in urls.mine(df, 0.02, 0.8).collect()}
    want = {}
    for size in (1, 2, 3):
        for s in itertools.combinations("abcdefghij", size):
            have = [v for t, v, _ in base if set(s) <= set(t)]
            if have:
                hits = have.count("block")
                if hits / 300 >= 0.02 and hits / len(have) >= 0.8:
                    want[s] = (round(hits / len(have), 9), round(hits / 300, 9))
    pruned = {s: v for s, v in want.items()
              if not any(set(o) < set(s) and want[o][0] >= v[0] for o in want)}
    assert got == pruned and got


# ---------------------------------------------------------------- 9 pieces

def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = pieces.default_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    p = pieces.Pieces(pieces.model_bytes(path))
    rng = random.Random(1)
    parts = ["a", "e", " ", "▁", "\n", "h", "é", "😀", "\x00", "中", "ß", "1", "th", "the", "ing", " the", "  ", "\t", "\r", "<0x41>", "</s>", "aaaa"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)] + ["a" * 3000, " " * 500, "ab" * 2000, "", " "]
    texts += [r.text for r in read(spark, "documents").limit(60).collect()]
    for t in texts:
        ids = sp.encode(t, add_eos=True)
        assert np.frombuffer(p.ids(t), np.int32).tolist() + [2] == ids
        assert p.decode(np.array(ids)) == sp.decode(ids)


def test_digests(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rows = [(1, "Hello there"), (2, None), (3, ""), (4, " x\n\ny  z "), (None, "again"), (1, "Hello there")]
    for r in pieces.digests(spark.createDataFrame(rows, DOC)).collect():
        ids = sp.encode({1: "Hello there", 2: "", 3: "", 4: " x\n\ny  z ", None: "again"}[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


# ---------------------------------------------------------------- 10 sharding

def test_sharding(spark):
    rng = random.Random(2)
    hot = words(rng, 50)
    rows = [(i, hot if i < 1500 else words(rng, rng.randint(1, 200), 50_000)) for i in range(4500)]
    rows += [(9000, None), (9001, ""), (9002, "é")]
    got = sharding.shards(spark.createDataFrame(rows, DOC), cells=4096).collect()
    text = dict(rows)
    load, count, slots = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    groups = collections.defaultdict(set)
    for r in got:
        t = text[r.doc_id]
        assert r.size == len((t or "").encode()) + 1
        assert r.text_crc32 == (None if t is None else zlib.crc32(t.encode()))
        load[r.shard] += r.size
        count[r.shard] += 1
        slots[r.shard].append(r.slot)
        groups[t].add(r.shard)
    assert len(got) == len(rows) and set(load) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) <= 1.01 * min(load.values()) and max(count.values()) <= 1.2 * min(count.values())
    assert all(len(s) == 1 for t, s in groups.items() if t != hot) and len(groups[hot]) > 1


def slow_place(vectors, n):
    """The same rule by plain loops."""
    dims = len(vectors[0])
    room, shard, load = [[1 / n] * dims for _ in range(n)], [0] * len(vectors), [[0.0] * dims for _ in range(n)]
    for i in sorted(range(len(vectors)), key=lambda i: -max(vectors[i])):
        s = max(range(n), key=lambda s: (sum(a * b for a, b in zip(room[s], vectors[i])), -s))
        shard[i] = s
        for d in range(dims):
            room[s][d] -= vectors[i][d]
            load[s][d] += vectors[i][d]

    def step():
        top = [max(x[d] for x in load) for d in range(dims)]
        order = sorted(range(n), key=lambda s: -load[s][0])
        for hi in order:
            for lo in reversed(order):
                gap = load[hi][0] - load[lo][0]
                fits = [i for i in range(len(vectors)) if shard[i] == hi and gap > 0 and vectors[i][0] < gap * (1 - 1e-9)
                        and all(load[lo][d] + vectors[i][d] <= top[d] + 1e-12 for d in range(dims))]
                if fits:
                    best = min(fits, key=lambda i: abs(vectors[i][0] - gap / 2))
                    for d in range(dims):
                        load[hi][d] -= vectors[best][d]
                        load[lo][d] += vectors[best][d]
                    shard[best] = lo
                    return True
        return False
    while step():
        pass
    return load


def test_place_equals_the_slow_placement():
    rng = np.random.default_rng(4)
    for k in range(6):
        v = rng.lognormal(sigma=1.0 + k / 3, size=(120, 3))
        v /= v.sum(axis=0)
        shard = sharding.place(v, 5)
        load = np.stack([np.bincount(shard, weights=v[:, d], minlength=5) for d in range(3)], axis=1)
        assert np.allclose(np.sort(load[:, 0]), np.sort(np.array(slow_place(v.tolist(), 5))[:, 0]))


def test_a_huge_vector_does_not_spoil_rows_and_tokens():
    """One item above a fair share: the last pass must not empty or overfill shards in the other dimensions."""
    rng = np.random.default_rng(6)
    v = rng.lognormal(sigma=1.5, size=(4000, 3))
    v[:, 2] = 1
    v[0] = v.sum(axis=0) * [0.12, 0.12, 0]
    v /= v.sum(axis=0)
    shard = sharding.place(v, 16)
    load = np.stack([np.bincount(shard, weights=v[:, d], minlength=16) for d in range(3)], axis=1) * 16
    assert load[:, 2].max() < 1.2 and load[1:, 1].max() < 2.2


def test_place_balances_all_dimensions():
    rng = np.random.default_rng(1)
    v = rng.gamma(0.5, size=(3000, 3))
    v /= v.sum(axis=0)
    shard = sharding.place(v, 8)
    sums = np.stack([np.bincount(shard, weights=v[:, d], minlength=8) for d in range(3)])
    assert sums[0].max() / sums[0].min() < 1.001 and sums[1:].max() / sums[1:].min() < 1.1
