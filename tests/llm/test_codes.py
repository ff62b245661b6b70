"""Operator 12 against plain Python loops over all entries."""

import hashlib
import math
import random

import numpy as np

from hirelens.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n long, total string"


def brute(rows):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max([len(v) for _, v, _ in kept], default=0)
    width += -width % 4
    low = lambda x: math.floor(1024 * x)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(i, [low(float(x)) for x in v] + [0] * (width - len(v)), lab) for i, v, lab in kept]
    step = width // 4
    part = lambda v, p: v[p * step:(p + 1) * step]
    books = [[part(v, p) for _, v, _ in kept[:256]] for p in range(4)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    find = lambda v, p: min((dist(part(v, p), e), i) for i, e in enumerate(books[p]))
    for _ in range(4):
        new = []
        for p in range(4):
            mine = [(find(v, p)[1], part(v, p)) for _, v, _ in kept]
            new.append([[sum(c) // len(c) for c in zip(*[s for j, s in mine if j == i])] if any(j == i for j, _ in mine) else e
                        for i, e in enumerate(books[p])])
        books = new
    out = [(i, "".join(f"{find(v, p)[1]:02x}" for p in range(4)), min(sum(find(v, p)[0] for p in range(4)), 2 ** 63 - 1), lab) for i, v, lab in kept]
    total = {}
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, c, e, min(total[lab], 2 ** 63 - 1)) for i, c, e, lab in out], key=str), sha


def run(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "c", 1, "t") for i, v, lab in rows], SCHEMA).repartition(3)
    out, books = codes.compress(df)
    return sorted([tuple(r) for r in out.collect()], key=str), codes.digest(books)


def f32(x):
    return float(np.float32(x))


def test_awkward_vectors(spark):
    rng = random.Random(3)
    vec = lambda n=8: [f32(rng.choice([0.0, 0.25, -0.25, 0.1, rng.uniform(-1, 1)])) for _ in range(n)]
    rows = [(i, vec(), rng.choice([None, 1, 2])) for i in range(300)]
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 1), (None, vec(), None), (None, vec(3), 4), (400, [], 4), (401, None, 1), (402, [1.0, None], 1),
             (403, [float("nan")] * 8, 1), (404, [float("inf")] + [0.0] * 7, 1), (405, [1e9, -1e9] + [0.5] * 6, 7), (406, vec(5), None)]
    assert run(spark, rows) == brute(rows)


def test_few_rows_ties_and_empty_tables(spark):
    rows = [(3, [0.5, 0.5, 0.0, 0.0], 1), (1, [0.5, 0.5, 0.0, 0.0], 1), (2, [-0.0001, 0.0, 1.0, 0.5], None)]
    assert run(spark, rows) == brute(rows)
    out, books = codes.compress(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and codes.digest(books) == hashlib.sha256(b"").hexdigest()
    assert run(spark, [(1, None, 1)])[0] == []


def test_search_equals_all_comparisons_and_skips(monkeypatch):
    """Nearest entries with lower index on ties; on grouped entries most are never compared."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-1000, 1000, (16, 6))
    entries = (centres[rng.integers(0, 16, 256)] + rng.integers(-8, 9, (256, 6))).astype(np.int64)
    entries[200] = entries[20]
    parts = np.concatenate([entries[rng.integers(0, 256, 500)] + rng.integers(-3, 4, (500, 6)), entries[200:201]]).astype(np.int64)
    compared = []
    plain = codes.squared

    def counting(a, b):
        compared.append(len(a))
        return plain(a, b)
    book = codes.Book(entries)
    monkeypatch.setattr(codes, "squared", counting)
    index, dist = book.nearest(parts)
    every = ((parts[:, None, :] - entries[None]) ** 2).sum(-1)
    assert (index == every.argmin(1)).all() and (dist == every.min(1)).all() and index[-1] == 20
    assert sum(compared) < 0.5 * every.size


def test_whole_numbers_floor_down():
    assert codes.whole(np.array([[-0.0001, 0.0009, 1.0, -1.0]])).tolist() == [[-1, 0, 1024, -1024]]
    assert codes.whole(np.array([[1e20, -1e20]])).tolist() == [[1024 * 10 ** 20, -1024 * 10 ** 20]]
