"""Operator 13, conversation structure repair by a run-length dynamic programme.

A conversation is a sequence of symbols: a row's role initial (s, u, a, other) with its fault
(truncated or not), or one symbol for rows that must go (blank, or role and text seen before).
Equal consecutive symbols form a run.  The states are what the repaired roles ended with (nothing,
system, user, assistant); a symbol is a 4 x 4 matrix of least edit costs, inserts before the row
included, and a run of n is its n-th power in (min, +), by cached binary powers.  Backwards the
powers give the least cost from every run's end; forwards the choices are unrolled, of equal cost
the ASCII-least edit first; a run is unrolled by halves, which repeat and are cached.

Long conversations are not bound to a task: rows are dealt by range of (conversation, turn, role,
text), each task forms pieces of at most ``PIECE`` runs, a conversation's pieces are linked by their
matrices alone (one small row for each PIECE runs), and pieces are unrolled apart from each other,
for each of the four states they may begin in.  Equal rows are counted before any shuffle.  Texts are
shuffled once, for the digest of the repaired rows: SHA-256 has to be fed in order, so this
last step streams a conversation through one task, in constant memory.

Damage: rows with null role or text, or a null conversation or turn in the damage key, have one space
for it.  Order within a turn: role, then text (by its first ``HEAD`` characters, then its md5).

Defined results: null conv_id is one conversation; null turns come first and count for no gap; equal
rows are copies, of which all but the first are duplicates; rows of very long text are never held
together; an empty table gives no rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import functools
import hashlib

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, claim, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Runs of one piece.
PIECE = 65_536
HEAD = 64
BLANKS = " \t\n\x0b\f\r"
ENDS = (".", "!", "?")

#: States: nothing, system, user, assistant last.  The state after an insert or a change of role.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
CLASSES = ("s", "u", "a", "o")
#: Least cost from each state at the end: inserts that complete a pair.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60
#: Symbols: 0 must go; 1 + class: sound; 5 + class: truncated.
GONE = 0


# ---------------------------------------------------------------- the run-length programme

def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) that consume a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        own, extra = CLASSES[(symbol - 1) % 4], TRUNCATED if symbol > 4 else 0
        if own == "s" and state == 0:
            out.append(("K", KEEP + extra, 1))
        elif own == CLASSES[NEXT[state] - 1]:
            out.append(("K", KEEP + extra, NEXT[state]))
        out.append(("R", REROLE + extra, NEXT[state]))
    return out


def times(a: tuple, b: tuple) -> tuple:
    """Product of two 4 x 4 matrices in (min, +)."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


@functools.lru_cache(maxsize=4096)
def power(symbol: int, bit: int) -> tuple:
    """Matrix of 2 ** bit rows of one symbol."""
    if bit:
        half = power(symbol, bit - 1)
        return times(half, half)
    rows = []
    for state in range(4):
        best, at, cost = [FAR] * 4, state, 0
        for _ in range(3):  # no, one or two inserts before the row; more come back to a state at a cost
            for _, c, to in choices(symbol, at):
                best[to] = min(best[to], cost + c)
            at, cost = NEXT[at], cost + INSERT
        rows.append(tuple(best))
    return tuple(rows)


def bits(n: int):
    return (b for b in range(n.bit_length()) if n >> b & 1)


@functools.lru_cache(maxsize=200_000)
def _before(symbol: int, n: int, after: tuple) -> tuple:
    for b in bits(n):
        m = power(symbol, b)
        after = tuple(min(m[i][j] + after[j] for j in range(4)) for i in range(4))
    return after


def before(symbol: int, n: int, after: tuple) -> tuple:
    """Least costs from before a run, given those from its end."""
    low = min(after)
    return tuple(x + low for x in _before(symbol, n, tuple(x - low for x in after)))


@functools.lru_cache(maxsize=200_000)
def _unroll(symbol: int, n: int, state: int, after: tuple) -> tuple[str, int]:
    if n > 1:
        half = 1 << (n - 1).bit_length() - 1
        first, state = unroll(symbol, half, state, before(symbol, n - half, after))
        rest, state = unroll(symbol, n - half, state, after)
        return first + rest, state
    edits, costs = "", before(symbol, 1, after)
    while True:
        options = sorted([*[(e, c + after[to], to, True) for e, c, to in choices(symbol, state)], ("I", INSERT + costs[NEXT[state]], NEXT[state], False)])
        edit, to, done = next((e, to, done) for e, c, to, done in options if c == costs[state])
        edits, state = edits + edit, to
        if done:
            return edits, state


def unroll(symbol: int, n: int, state: int, after: tuple) -> tuple[str, int]:
    """(edits, next state) of the cheapest way through a run from ``state``, ties ASCII-least."""
    low = min(after)
    return _unroll(symbol, n, state, tuple(x - low for x in after))


def solve(runs, end: tuple = END) -> tuple[list[tuple], tuple]:
    """Least costs from the end of each run, and from the beginning."""
    ends = []
    for symbol, n in reversed(runs):
        ends.append(end)
        end = before(symbol, n, end)
    return ends[::-1], end


def walk(runs, ends, state: int) -> tuple[str, int]:
    """Edits of the runs from ``state``, and the state they end in."""
    out = []
    for (symbol, n), end in zip(runs, ends):
        edits, state = unroll(symbol, n, state, end)
        out.append(edits)
    return "".join(out), state


def closing(state: int) -> str:
    """Inserts after the last row."""
    return "I" * (END[state] // INSERT)


def product(runs) -> tuple:
    """Matrix of a sequence of runs."""
    out = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
    for symbol, n in runs:
        for b in bits(n):
            out = times(out, power(symbol, b))
    return out


def illegal_pair(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


# ---------------------------------------------------------------- rows and faults

def space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and n (0: dropped, 2: repeated) after damage, with order columns."""
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    d = conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
                             F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"))
    return d.withColumn("head", F.substring("text", 1, HEAD)).withColumn("md5", F.md5(F.col("text").cast("binary")))


ORDER = ["conv_id", "turn", "role", "head", "md5"]


def faults(rows: DataFrame) -> DataFrame:
    """One row for each set of equal rows, in ORDER's columns: n, initial, symbol of the first copy
    (the others must go), blank, is_first (of its role and text)."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    sets = rows.select(*ORDER, "n", (trimmed == "").alias("blank"), F.substring(trimmed, -1, 1).isin(*ENDS).alias("ended"))
    sets = sets.groupBy(*ORDER, "blank", "ended").agg(F.sum("n").alias("n"))
    live = sets.filter("n > 0")
    # the first turn of each role and text: a join by the whole key, so no text is one task's
    first = (live.groupBy("conv_id", "role", "md5").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("f"))
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("md5").alias("m"), F.col("f.turn").alias("t"), F.lit(True).alias("first")))
    same = sets["conv_id"].eqNullSafe(first["c"]) & sets["turn"].eqNullSafe(first["t"]) & (sets["role"] == first["r"]) & (sets["md5"] == first["m"])
    out = sets.join(first, same, "left").drop("c", "r", "m", "t").withColumn("is_first", F.coalesce("first", F.lit(False))).drop("first")
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.when(F.col("blank") | ~F.col("is_first"), GONE).otherwise(1 + place + F.when(F.col("ended"), 0).otherwise(4))
    return out.select(*ORDER, "n", initial.alias("initial"), symbol.cast("int").alias("symbol"), "blank", "is_first", "ended")


def counts(sets: DataFrame) -> DataFrame:
    """conv_id (all), gaps, blank, duplicate, truncated."""
    live = F.col("n") > 0
    by_turn = sets.groupBy("conv_id", "turn").agg(
        F.max(live).alias("live"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - F.when(F.col("is_first"), 1).otherwise(0)).otherwise(0)).alias("duplicate"),
        F.sum(F.when(live & ~F.col("blank") & F.col("is_first") & ~F.col("ended"), 1).otherwise(0)).alias("truncated"))
    turn = F.when(F.col("live"), F.col("turn")).cast("decimal(38,0)")
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0).cast("decimal(38,0)"))
    return by_turn.groupBy("conv_id").agg(F.least(gaps, F.lit(2 ** 63 - 1).cast("decimal(38,0)")).cast("long").alias("gaps"),
                                          *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])


# ---------------------------------------------------------------- pieces

PIECES = ("conv_id {id}, turn {turn}, role string, head string, md5 string, place long, whole boolean, audit string, cost long, illegal long, "
          "first string, last string, symbols array<int>, lengths array<long>, matrix array<long>")


class Piece:
    """Consecutive rows of one conversation."""

    def __init__(self, key: tuple, initial: str):
        self.key, self.first, self.last = key, initial, None
        self.symbols, self.lengths, self.illegal = [], [], 0

    def add(self, symbol: int, n: int) -> None:
        if self.symbols and self.symbols[-1] == symbol:
            self.lengths[-1] += n
        else:
            self.symbols.append(symbol)
            self.lengths.append(n)

    def row(self, place: int, whole: bool) -> tuple:
        runs = tuple(zip(self.symbols, self.lengths))
        if whole:
            audit, cost = short(runs) if len(runs) <= 24 else direct(runs)
            return (*self.key, place, True, audit, cost, self.illegal, self.first, self.last, None, None, None)
        return (*self.key, place, False, None, None, self.illegal, self.first, self.last, self.symbols, self.lengths,
                [x for line in product(runs) for x in line])


def direct(runs) -> tuple[str, int]:
    """Audit and cost of a whole conversation."""
    ends, costs = solve(runs)
    audit, state = walk(runs, ends, 0)
    return audit + closing(state), costs[0]


short = functools.lru_cache(maxsize=100_000)(direct)


def forget() -> None:
    """Free what a worker remembers of runs and conversations."""
    for cache in (power, _before, _unroll, short):
        cache.cache_clear()


def as_batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def arrow_type(simple: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "smallint": pa.int16(), "tinyint": pa.int8(),
            "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}[simple]


def pieces(sets: DataFrame, most: int = PIECE) -> DataFrame:
    """Pieces in the order of ``place``; conversations that a task sees from end to end are solved there."""
    types = {f.name: f.dataType.simpleString() for f in sets.schema.fields}
    ddl = PIECES.format(id=types["conv_id"], turn=types["turn"])
    schema = pa.schema([(c.split()[0], arrow_type(c.split()[1].replace("long", "bigint"))) for c in ddl.split(", ")])

    def run(batches):
        claim("turns", forget)
        place, pending, out = TaskContext.get().partitionId() << 40, [], []
        # conversations at either end of the task may go on in the next one
        outer, now = True, None
        for batch in batches:
            for conv, turn, role, head, md5, n, initial, symbol in zip(*[batch.column(c).to_pylist() for c in (*ORDER, "n", "initial", "symbol")]):
                if now is None or now.key[0] != conv:
                    if now is not None:
                        pending.append(now)
                        for p in pending:
                            out.append(p.row(place, not outer and len(pending) == 1))
                            place += 1
                        pending, outer = [], False
                    now = Piece((conv, turn, role, head, md5), initial)
                elif len(now.symbols) >= most:
                    pending.append(now)
                    if len(pending) > 1:  # a long conversation's pieces leave as they come
                        out.extend(p.row(place + i, False) for i, p in enumerate(pending))
                        place += len(pending)
                        pending, outer = [], True
                    now = Piece((conv, turn, role, head, md5), initial)
                else:
                    now.illegal += illegal_pair(now.last, initial)
                now.last = initial
                now.illegal += n - 1
                now.add(symbol, 1)
                if n > 1:
                    now.add(GONE, n - 1)
                if len(out) >= 4096 or (out and len(now.symbols) >= most):
                    yield as_batch(out, schema)
                    out = []
        if now is not None:
            pending.append(now)
            out.extend(p.row(place + i, False) for i, p in enumerate(pending))
        yield as_batch(out, schema)

    live = sets.filter("n > 0").select(*ORDER, "n", "initial", "symbol")
    return live.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, ddl)


def linked(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """The pieces that are not whole, with their audit, and cost and illegal pairs of their conversation."""
    def ends(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("place")
        end, out = END, []
        for m in reversed(list(g["matrix"])):
            out.append(list(end))
            end = tuple(min(int(m[4 * i + j]) + end[j] for j in range(4)) for i in range(4))
        firsts, lasts = list(g["first"]), list(g["last"])
        illegal = int(g["illegal"].sum()) + sum(illegal_pair(a, b) for a, b in zip(lasts, firsts[1:]))
        return pd.DataFrame({"place": g["place"], "after": out[::-1], "cost": end[0], "illegal": illegal, "final": [False] * (len(g) - 1) + [True]})

    def ways(batches):
        claim("turns", forget)
        for batch in batches:
            rows = []
            for place, symbols, lengths, after in zip(*[batch.column(c).to_pylist() for c in ("place", "symbols", "lengths", "after")]):
                runs = list(zip(symbols, lengths))
                after_each, _ = solve(runs, tuple(after))
                found = [walk(runs, after_each, s) if after_each[0][s] < FAR else ("", s) for s in range(4)]
                rows.append((place, [a for a, _ in found], [s for _, s in found]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string())),
                                              pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["place", "audits", "exits"])

    def entries(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("place")
        state, out = 0, []
        for exits in g["exits"]:
            out.append(state)
            state = int(exits[state])
        return pd.DataFrame({"place": g["place"], "entry": out, "closing": [""] * (len(g) - 1) + [closing(state)]})

    parts = parts.filter("not whole")
    after = scratch.write(parts.select("conv_id", "place", "matrix", "first", "last", "illegal").groupBy("conv_id")
                          .applyInPandas(ends, "place long, after array<long>, cost long, illegal long, final boolean"), "after")
    found = parts.select("place", "symbols", "lengths").join(after.select("place", "after"), "place")
    found = scratch.write(found.mapInArrow(ways, "place long, audits array<string>, exits array<int>"), "ways")
    state = (found.select("place", "exits").join(parts.select("conv_id", "place"), "place").groupBy("conv_id")
             .applyInPandas(entries, "place long, entry int, closing string"))
    audit = found.join(state, "place").select("place", F.concat(F.get("audits", F.col("entry")), "closing").alias("audit"))
    return parts.select(*ORDER, "place").join(after.select("place", "cost", "illegal"), "place").join(audit, "place")


# ---------------------------------------------------------------- repaired rows

def stream(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows in order with the audit of each piece before its first row, a conversation in one task."""
    marks = solved.select(*ORDER, F.lit(0).alias("flag"), "audit", F.lit(None).cast("string").alias("text"), F.lit(0).alias("n"))
    own = rows.filter("n > 0").select(*ORDER, F.lit(1).alias("flag"), F.lit(None).cast("string").alias("audit"), "text", "n")
    return marks.unionByName(own).repartition("conv_id").sortWithinPartitions(*ORDER, "flag")


class Repair:
    """Follows an audit over the rows of a conversation; yields (role, text) of the repaired one."""

    def __init__(self):
        self.state, self.audit, self.at = 0, "", 0

    def begin(self, audit: str):
        yield from self.finish()
        self.audit, self.at = audit, 0

    def row(self, role: str, text: str):
        while self.audit[self.at] == "I":
            yield self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "K" and self.state == 0 and role.startswith("s"):
            self.state = 1
        else:
            self.state = NEXT[self.state]
        yield (role if edit == "K" else ROLE[self.state]), text

    def _insert(self):
        self.at += 1
        self.state = NEXT[self.state]
        return ROLE[self.state], ""

    def finish(self):
        while self.at < len(self.audit):
            yield self._insert()


def walked(batches):
    """(conv_id, role, text) of the repaired rows of a sorted stream; (conv_id, None, None) after each conversation."""
    now, repair, started = None, Repair(), False
    for batch in batches:
        for conv, flag, audit, role, text, n in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "flag", "audit", "role", "text", "n")]):
            if not started or conv != now:
                if started:
                    yield from ((now, r, t) for r, t in repair.finish())
                    yield now, None, None
                now, repair, started = conv, Repair(), True
            step = repair.begin(audit) if flag == 0 else (x for _ in range(n) for x in repair.row(role, text))
            yield from ((now, r, t) for r, t in step)
    if started:
        yield from ((now, r, t) for r, t in repair.finish())
        yield now, None, None


def digests(sorted_rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of a ``stream``."""
    id_type = sorted_rows.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", arrow_type(id_type)), ("repaired_sha256", pa.string())])

    def run(batches):
        out, sha, first = [], hashlib.sha256(), True
        for conv, role, text in walked(batches):
            if role is None:
                out.append((conv, sha.hexdigest()))
                sha, first = hashlib.sha256(), True
                if len(out) >= 4096:
                    yield as_batch(out, schema)
                    out = []
            else:
                sha.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False
        yield as_batch(out, schema)

    return sorted_rows.mapInArrow(run, f"conv_id {id_type}, repaired_sha256 string")


def repaired(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """conv_id, position, role, text: the repaired conversations themselves."""
    s = stream(rows, solved)
    id_type = s.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", arrow_type(id_type)), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        out, at = [], 0
        for conv, role, text in walked(batches):
            if role is None:
                at = 0
                continue
            out.append((conv, at, role, text))
            at += 1
            if len(out) >= 512:
                yield as_batch(out, schema)
                out = []
        yield as_batch(out, schema)

    return s.mapInArrow(run, f"conv_id {id_type}, position long, role string, text string")


def solve_all(rows: DataFrame, scratch: Scratch, most: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(counts by conversation, pieces with audit, cost and illegal pairs) of ``rows`` (conv_id, turn, role, text, n, head, md5)."""
    sets = scratch.write(faults(rows), "sets")
    parts = scratch.write(pieces(sets, most), "pieces")
    columns = [*ORDER, "place", "cost", "illegal", "audit"]
    solved = scratch.write(parts.filter("whole").select(*columns).unionByName(linked(parts, scratch).select(*columns)), "solved")
    return counts(sets), solved


def report(rows: DataFrame, most: int = PIECE) -> DataFrame:
    """One row for each conversation of ``rows`` (as of ``damaged``): its faults, cost, audit and the digest of its repair."""
    faulty, solved = solve_all(rows, Scratch(rows.sparkSession, "turns"), most)
    # the pieces of one conversation in order; almost always one
    audits = (solved.groupBy("conv_id").agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost"),
                                            F.array_sort(F.collect_list(F.struct("place", "audit"))).alias("p"))
              .select(F.col("conv_id").alias("c"), "illegal", "cost", F.array_join(F.col("p.audit"), "").alias("audit")))
    sha = digests(stream(rows, solved)).withColumnRenamed("conv_id", "d")
    out = faulty.join(audits, faulty["conv_id"].eqNullSafe(audits["c"]), "left").join(sha, faulty["conv_id"].eqNullSafe(sha["d"]), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13(spark, sf_dir) -> DataFrame:
    return report(damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


#: The same in DuckDB: costs by recursion from the last row, edits by recursion from the first.  Without
#: runs; crc32 by its polynomial, bit by bit.
ORACLE = """
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
       lambda c: CAST(ascii(c) AS BIGINT))), lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS c FROM conversations),
key AS (SELECT *, xor(c, 4294967295) % 20 AS k FROM src),
dmg AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
       CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
       unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM key WHERE k <> 0),
ord AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
       regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+\\z', '') AS r FROM dmg),
flt AS (SELECT conv_id, turn, role, text, i, role[1:1] AS ini, r = '' AS blank,
       row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, right(r, 1) NOT IN ('.', '!', '?') AS cut FROM ord),
sym AS MATERIALIZED (SELECT conv_id, turn, role, text, i, ini, blank, again AND NOT blank AS dup, cut AND NOT blank AND NOT again AS tr,
       blank OR again AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS t, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev,
       count(*) OVER (PARTITION BY conv_id) AS n FROM flt),
back AS (SELECT conv_id, max(n) + 1 AS i, 0 AS v0, 10 AS v1, 5 AS v2, 0 AS v3 FROM sym GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, least(w0, 5 + least(w2, 5 + w3)) AS v0, least(w1, 5 + least(w2, 5 + w3)) AS v1, least(w2, 5 + w3) AS v2, least(w3, 5 + w2) AS v3
  FROM (SELECT s.conv_id, s.i, CASE WHEN gone THEN 2 + v0 ELSE least(2 + v0, CASE WHEN ini = 's' THEN t + v1 ELSE 1000000 END, t + (CASE WHEN ini = 'u' THEN 0 ELSE 1 END) + v2) END AS w0,
        CASE WHEN gone THEN 2 + v1 ELSE least(2 + v1, t + (CASE WHEN ini = 'u' THEN 0 ELSE 1 END) + v2) END AS w1,
        CASE WHEN gone THEN 2 + v2 ELSE least(2 + v2, t + (CASE WHEN ini = 'a' THEN 0 ELSE 1 END) + v3) END AS w2,
        CASE WHEN gone THEN 2 + v3 ELSE least(2 + v3, t + (CASE WHEN ini = 'u' THEN 0 ELSE 1 END) + v2) END AS w3
        FROM back b JOIN sym s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i - 1)),
costs AS MATERIALIZED (SELECT conv_id, i, [v0, v1, v2, v3] AS v FROM back),
steps AS MATERIALIZED (SELECT c.conv_id, c.i, c.v, d.v AS w, s.role, s.text, s.ini, s.t, s.gone FROM costs c
       LEFT JOIN costs d ON d.conv_id IS NOT DISTINCT FROM c.conv_id AND d.i = c.i + 1
       LEFT JOIN sym s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.i),
fwd AS (SELECT DISTINCT conv_id, CAST(1 AS BIGINT) AS i, 0 AS q, '' AS audit, '' AS body FROM sym
  UNION ALL
  SELECT conv_id, i + CASE WHEN e = 'I' THEN 0 ELSE 1 END, CASE WHEN e = 'D' THEN q WHEN e = 'K' AND q = 0 AND ini = 's' THEN 1 ELSE nx END, audit || e,
         body || CASE e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
                 ELSE chr(10) || (CASE nx WHEN 2 THEN 'user' ELSE 'assistant' END) || ':' || (CASE e WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT f.*, s.role, s.text, s.ini, CASE WHEN f.q = 2 THEN 3 ELSE 2 END AS nx,
        CASE WHEN s.w IS NULL THEN 'I' WHEN 2 + s.w[f.q + 1] = s.v[f.q + 1] THEN 'D' WHEN 5 + s.v[CASE WHEN f.q = 2 THEN 4 ELSE 3 END] = s.v[f.q + 1] THEN 'I'
             WHEN f.q = 0 AND s.ini = 's' AND s.t + s.w[2] = s.v[1] THEN 'K'
             WHEN s.ini = (CASE WHEN f.q = 2 THEN 'a' ELSE 'u' END) AND s.t + s.w[CASE WHEN f.q = 2 THEN 4 ELSE 3 END] = s.v[f.q + 1] THEN 'K' ELSE 'R' END AS e
        FROM fwd f JOIN steps s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.i WHERE s.w IS NOT NULL OR s.v[f.q + 1] > 0)),
fin AS (SELECT conv_id, arg_max(audit, length(audit)) AS audit, arg_max(body, length(audit)) AS body FROM fwd GROUP BY conv_id),
tot AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE dup) AS duplicate,
       count(*) FILTER (WHERE tr) AS truncated, count(*) FILTER (WHERE i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM sym GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(v[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body[2:], '')) AS repaired_sha256
FROM ids LEFT JOIN tot ON tot.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN costs c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id AND c.i = 1
"""
