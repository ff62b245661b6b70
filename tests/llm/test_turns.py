"""Operator 13 against plain Python that carries the whole audit through every state."""

import hashlib
import random
import re
import zlib

import pytest

from hirelens.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, n long, audit string, flag int"
SPACE = " \t\n\x0b\f\r"


def cheapest(rows):
    """(cost, audit) of rows (initial, must go, truncated): least cost, then ASCII-least, over all edits."""
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "")}

    def keep(to, state, cost, audit):
        if state not in to or (cost, audit) < to[state]:
            to[state] = (cost, audit)

    def inserts(at):
        for _ in range(3):
            for s, (c, a) in list(at.items()):
                keep(at, nxt[s], c + 5, a + "I")
        return at
    for ini, gone, cut in rows:
        to = {}
        for s, (c, a) in inserts(best).items():
            keep(to, s, c + 2, a + "D")
            if not gone:
                t = 5 if cut else 0
                if ini == "s" and s == 0:
                    keep(to, 1, c + t, a + "K")
                if ini == {2: "u", 3: "a"}[nxt[s]]:
                    keep(to, nxt[s], c + t, a + "K")
                keep(to, nxt[s], c + t + 1, a + "R")
        best = to
    return min(v for s, v in inserts(best).items() if s in (0, 3))


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        out = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        k = zlib.crc32(key.encode()) % 20
        role = "user" if k == 4 else role
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    result = []
    for conv, out in convs.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in out:
            t = text.rstrip(SPACE)
            faults.append("blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = cheapest([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(out, faults)])
        known = [r[0] for r in out if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
        fixed, rest, last = [], list(out), None
        for e in audit:
            if e != "I":
                _, role, text = rest.pop(0)
            want = "assistant" if last == "u" else "user"
            if e != "D":
                fixed.append((role if e == "K" else want, "" if e == "I" else text))
                last = fixed[-1][0][0]
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in fixed))
        result.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha, fixed))
    return sorted(result, key=lambda r: str(r[0]))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "audit", 3) for r in rows], SCHEMA)


def check(spark, rows, most=turns.PIECE):
    d = turns.damaged(frame(spark, rows).repartition(3))
    got = sorted([tuple(r) for r in turns.report(d, most).collect()], key=lambda r: str(r[0]))
    want = brute(rows)
    assert got == [w[:-1] for w in want]
    return want


def test_runs_equal_single_rows():
    """Powers and halves against the plain programme, on random runs."""
    rng = random.Random(13)
    for _ in range(300):
        runs = [(rng.randrange(9), rng.choice([1, 1, 2, 3, 7, 20])) for _ in range(rng.randrange(0, 7))]
        rows = [("suao"[(s - 1) % 4] if s else "u", s == 0, s > 4) for s, n in runs for _ in range(n)]
        assert turns.direct(tuple(runs)) == cheapest(rows)[::-1]


def test_random_conversations(spark):
    rng = random.Random(1)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher"]
    texts = ["Yes.", "no", "", "  \n", "Why?", "cut off", None, "end! \t", "é.", "."]
    rows = [(c, t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(10**6)}{rng.choice(['.', ''])}")
            for c in range(120) for t in range(rng.randrange(1, 12)) if rng.random() < 0.9]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (500, None, "user", "a."), (500, None, "user", "a."), (500, None, "assistant", "b."),
             (500, 3, "user", "a."), (501, None, None, None), (502, 10**18, "user", "x" * 200_000 + "."), (502, -10**18, "user", "x" * 200_000 + "!"),
             (503, 5, "system", "s."), (503, 5, "user", "u."), (503, 5, "user", "u."), (503, 6, "assistant", "v.")]
    check(spark, rows)


@pytest.mark.parametrize("most", [turns.PIECE, 40])
def test_long_conversations_in_pieces(spark, most):
    """Conversations over many tasks and pieces: long runs of one symbol, of copies, and none."""
    rng = random.Random(2)
    rows = [(7, t, ["user", "assistant"][t % 2], f"t{t}.") for t in range(900)]
    rows += [(8, t, "user", f"t{t}.") for t in range(700)]
    rows += [(9, t // 3, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["same.", f"t{t}", f"t{t}."])) for t in range(800)]
    rows += [(10, t, "assistant", "same.") for t in range(300)] + [(c, 0, "user", "Hi.") for c in range(11, 30)]
    want = check(spark, rows, most)
    assert len(want[0][7]) > 0 and max(len(w[7]) for w in want) > 800


def test_repaired_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b."), (1, 2, "tool", "c."), (2, 0, "assistant", "d.")]
    d = turns.damaged(frame(spark, rows))
    from hirelens.llm.common import Scratch
    _, solved = turns.solve_all(d, Scratch(spark, "t"))
    got = {}
    for r in sorted(turns.repaired(d, solved).collect()):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {w[0]: w[-1] for w in brute(rows) if w[-1]}
    assert turns.report(turns.damaged(frame(spark, []))).count() == 0
