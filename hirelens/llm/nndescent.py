"""Operator 4, embedding near-dedup: NN-descent within equal labels.

1. Equal vectors of one label form a class, which is one node of the graph from here on.
2. First lists: the nodes are sorted along several random projections (sign codes of random
   hyperplanes, range-partitioned, so a label may have any size) and compared with their next
   neighbours in that order.
3. NN-descent: each node's neighbours and reverse neighbours (a bounded number) are compared with
   each other, pairs with at least one new entry only; what is nearer than a node's farthest
   neighbour enters its list of ``K``.  Rounds end when a round finds hardly any new link.
   Vectors travel as 8-bit numbers; links are confirmed in double precision.
4. A list that is full of links is saturated: its node may have more.  The components with such
   a node are compared in full, with themselves and with each other (within a label), in blocks of
   about ``BLOCK`` nodes; only the count of links leaves a block pair, never the pairs.  Block pairs
   whose centres are too far apart for their radii and the threshold hold no link and are left out.
   Components that meet are joined.  A node of any other component has room in its list for all
   its links.
5. Audit: of a hash sample of about ``AUDIT`` nodes all links are found by brute force; where a
   label misses a recall of ``RECALL``, over its audited links or over its audited nodes, further
   rounds follow, with longer lists.  A label that still misses it is compared in full.

Links have a cosine of at least the threshold; none below is kept.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and
vectors without label, link with nothing and are their own component; vectors of different length
never link; repeated rows are other vectors; a null vec_id is never the smallest of a component
that has another one; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, components, table

THRESHOLD = 0.98
K = 12
ORDERS = 6
AHEAD = 6
BITS = 16
ROUNDS = 5
SETTLED = 0.002
BLOCK = 1024
AUDIT = 300
RECALL = 0.95
#: What the 8-bit vectors may be off at most; candidates are confirmed above threshold - SLACK.
SLACK = 0.015


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """Rows of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype)


def usable(embedding: Column, label: Column) -> Column:
    e = embedding.cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def classes_of(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """node, k1, k2, label, size, unit (array<double>), min_id, copies."""
    e = F.col("embedding").cast("array<double>")
    norm = F.sqrt(F.aggregate(e, F.lit(0.0), lambda s, x: s + x * x))
    good = rows.filter("good").groupBy("k1", "k2").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
        F.min("vec_id").alias("min_id"), F.count("*").alias("copies"))
    good = good.withColumn("norm", norm).select(
        F.monotonically_increasing_id().alias("node"), "k1", "k2", "label", F.size("embedding").alias("size"),
        F.transform(e, lambda x: x / F.col("norm")).alias("unit"), "min_id", "copies")
    return scratch.write(good, "classes")


def compact(classes: DataFrame) -> DataFrame:
    """node, label, size, q (8-bit vector)."""
    def run(batches):
        for b in batches:
            q = []
            for u in b.column(3).to_pylist():
                u = np.array(u)
                q.append(np.rint(u * (127.0 / np.abs(u).max())).astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(q, pa.binary())], ["node", "label", "size", "q"])

    t = classes.schema["label"].dataType.simpleString()
    return classes.select("node", "label", "size", "unit").mapInArrow(run, f"node long, label {t}, size int, q binary")


def _unit32(q: list[bytes]) -> np.ndarray:
    a = np.frombuffer(b"".join(q), np.int8).reshape(len(q), -1).astype(np.float32)
    return a / np.sqrt((a * a).sum(axis=1, keepdims=True))


PAIR = "a long, b long, s float"


def _pairs(a, b, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float32())], ["a", "b", "s"])


def first_pairs(nodes: DataFrame) -> DataFrame:
    """Neighbours in the order of random sign codes."""
    def code(batches):
        for b in batches:
            size = b.column(2).to_numpy()
            q = b.column(3).to_pylist()
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                u = _unit32([q[i] for i in at])
                for t in range(ORDERS):
                    planes = np.random.default_rng(1000 * t + int(dim)).standard_normal((int(dim), BITS)).astype(np.float32)
                    codes = ((u @ planes) > 0).astype(np.int64) @ (1 << np.arange(BITS)[::-1])
                    cols = [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), b.column(2).take(pa.array(at)),
                            pa.array(np.full(len(at), t), pa.int32()), pa.array(codes, pa.int64()), b.column(3).take(pa.array(at))]
                    yield pa.RecordBatch.from_arrays(cols, ["node", "label", "size", "turn", "code", "q"])

    def slide(batches):
        held = None
        for b in batches:
            new = b.to_pandas()
            d = new if held is None else pd.concat([held, new], ignore_index=True)
            old = 0 if held is None else len(held)
            start = np.flatnonzero(np.concatenate([[True], (d[["turn", "label", "size"]].to_numpy()[1:] != d[["turn", "label", "size"]].to_numpy()[:-1]).any(axis=1)]))
            node = d["node"].to_numpy()
            for lo, hi in zip(start, np.append(start[1:], len(d))):
                if hi - lo < 2 or hi <= old:
                    continue
                u = _unit32(d["q"].iloc[lo:hi].tolist())
                for step in range(1, min(AHEAD, hi - lo - 1) + 1):
                    s = (u[:-step] * u[step:]).sum(axis=1)
                    keep = np.arange(lo + step, hi) >= old
                    if keep.any():
                        yield _pairs(node[lo:hi - step][keep], node[lo + step:hi][keep], s[keep])
            held = d.tail(AHEAD)

    t = nodes.schema["label"].dataType.simpleString()
    coded = nodes.mapInArrow(code, f"node long, label {t}, size int, turn int, code long, q binary")
    order = ["turn", "label", "size", "code", "node"]
    spread = coded.repartitionByRange(*order).sortWithinPartitions(*order)
    return spread.select("node", "label", "size", "turn", "code", "q").mapInArrow(slide, PAIR)


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest (u, v, s, fresh) of each u; pairs (a, b, s, fresh) count both ways."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "s", "fresh").unionByName(
        pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "s", "fresh"))
    once = both.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("u").orderBy(F.desc("s"), F.xxhash64("u", "v"))
    return once.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r")


def descend(lists: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Pairs (a, b, s) among neighbours of a node that may enter a list."""
    floor = lists.groupBy("u").agg(F.min("s").alias("least"), F.count("*").alias("n")).select(
        F.col("u").alias("x"), F.when(F.col("n") >= k, F.col("least")).otherwise(-2.0).cast("float").alias("floor"))
    w = Window.partitionBy("m").orderBy(F.xxhash64("m", "x"))
    back = (lists.select(F.col("v").alias("m"), F.col("u").alias("x"), "fresh")
            .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r"))
    near = lists.select(F.col("u").alias("m"), F.col("v").alias("x"), "fresh").unionByName(back)
    state = nodes.select(F.col("node").alias("x"), "q").join(floor, "x", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0).cast("float")))
    grouped = (near.groupBy("m", "x").agg(F.max("fresh").alias("fresh")).join(state, "x")
               .groupBy("m").agg(F.collect_list(F.struct("x", "fresh", "floor", "q")).alias("near"))
               .filter(F.exists("near", lambda e: e["fresh"])))

    def join(batches):
        for batch in batches:
            out = [[], [], []]
            for near in batch.column(0).to_pylist():
                if len(near) < 2:
                    continue
                x = np.array([e["x"] for e in near])
                fresh = np.array([e["fresh"] for e in near])
                floor = np.array([e["floor"] for e in near], np.float32)
                u = _unit32([e["q"] for e in near])
                s = u @ u.T
                i, j = np.nonzero(np.triu((fresh[:, None] | fresh[None, :]) & (s > np.minimum(floor[:, None], floor[None, :])), 1))
                for c, v in zip(out, (x[i], x[j], s[i, j])):
                    c.append(v)
            if out[0]:
                yield _pairs(*map(np.concatenate, out))

    return grouped.select("near").mapInArrow(join, PAIR)


def confirmed(lists: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The links (a < b) of the lists, in double precision."""
    unit = lambda side: classes.select(F.col("node").alias(side), F.col("unit").alias(f"u_{side}"))

    @F.arrow_udf("double")
    def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([float(np.dot(x, y)) for x, y in zip(*(
            [c.values.to_numpy()[i:j] for i, j in zip(c.offsets.to_numpy()[:-1], c.offsets.to_numpy()[1:])] for c in (a, b)))], pa.float64())

    likely = lists.filter(F.col("s") >= threshold - SLACK).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    return likely.join(unit("a"), "a").join(unit("b"), "b").filter(cosine("u_a", "u_b") >= threshold).select("a", "b")


def audit(classes: DataFrame, threshold: float, size: int = AUDIT) -> DataFrame:
    """(a, b): all links of a hash sample of about ``size`` nodes, by brute force."""
    n = classes.count()
    share = min(1.0, size / max(1, n))
    sample = classes.filter(F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).select("node", "label", "size", "unit")
    picked = sample.limit(4 * size).toPandas()  # about ``size`` rows
    groups = {key: (g["node"].to_numpy(), np.stack(g["unit"].to_numpy())) for key, g in picked.groupby(["label", "size"])}

    def run(batches):
        for b in batches:
            d = b.to_pandas()
            for key, g in d.groupby(["label", "size"]):
                if key in groups:
                    nodes, units = groups[key]
                    s = units @ np.stack(g["unit"].to_numpy()).T
                    i, j = np.nonzero(s >= threshold)
                    other = g["node"].to_numpy()[j]
                    keep = nodes[i] != other
                    yield _pairs(nodes[i][keep], other[keep], s[i, j][keep])

    return classes.select("node", "label", "size", "unit").mapInArrow(run, PAIR).select("a", "b")


def near_blocks(blocks: DataFrame, threshold: float) -> DataFrame:
    """(ca, ba, cb, bb): pairs of blocks (label, size, comp, blk, radius, centre) of one label that
    may hold links: centres no farther apart than the threshold's angle and both radii.  A block
    pairs with itself."""
    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        left, right = pdf[pdf["cell"] == i], pdf[pdf["cell"] == j]
        out = pd.DataFrame({"ca": [], "ba": [], "cb": [], "bb": []}, dtype="int64")
        if len(left) and len(right):
            angle = np.arccos(np.clip(np.stack(left["centre"].to_numpy()) @ np.stack(right["centre"].to_numpy()).T, -1, 1))
            reach = left["radius"].to_numpy()[:, None] + right["radius"].to_numpy()[None, :]
            a, b = np.nonzero(angle <= np.arccos(min(1.0, threshold)) + reach + 1e-6)
            a, b = (a[a <= b], b[a <= b]) if i == j else (a, b)
            out = pd.DataFrame({"ca": left["comp"].to_numpy()[a], "ba": left["blk"].to_numpy()[a],
                                "cb": right["comp"].to_numpy()[b], "bb": right["blk"].to_numpy()[b]})
        return out

    cells = blocks.groupBy("label", "size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cells"))
    c = blocks.join(cells, ["label", "size"]).withColumn("cell", F.pmod(F.xxhash64("comp", "blk"), F.col("cells")).cast("int"))
    c = c.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    c = c.select("label", "size", F.least("cell", "o").alias("i"), F.greatest("cell", "o").alias("j"), "cell", "comp", "blk", "radius", "centre")
    return c.groupBy("label", "size", "i", "j").applyInPandas(near, "ca long, ba int, cb long, bb int")


def block_links(members: DataFrame, threshold: float, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp, other, links): the links of each node to nodes of each component, all of
    ``members`` (node, comp, label, size, copies, unit) compared by pairs of blocks."""
    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        u = np.stack(pdf["unit"].to_numpy())
        c = u.mean(axis=0)
        c /= np.linalg.norm(c) or 1.0
        return pdf[["label", "size", "comp", "blk"]].head(1).assign(radius=float(np.arccos(np.clip((u @ c).min(), -1, 1))), centre=[c.tolist()])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[~pdf["right"]], pdf[pdf["right"]]
        ca, cb = pdf["ca"].iloc[0], pdf["cb"].iloc[0]
        if not len(right):
            hit = np.stack(left["unit"].to_numpy()) @ np.stack(left["unit"].to_numpy()).T >= threshold
            np.fill_diagonal(hit, False)
            out = pd.DataFrame({"node": left["node"], "comp": ca, "other": cb, "links": hit @ left["copies"].to_numpy()})
        else:
            hit = np.stack(left["unit"].to_numpy()) @ np.stack(right["unit"].to_numpy()).T >= threshold
            out = pd.concat([pd.DataFrame({"node": left["node"], "comp": ca, "other": cb, "links": hit @ right["copies"].to_numpy()}),
                             pd.DataFrame({"node": right["node"], "comp": cb, "other": ca, "links": hit.T @ left["copies"].to_numpy()})])
        return out[out["links"] > 0]

    t = members.schema["label"].dataType.simpleString()
    sizes = members.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
    m = members.join(sizes, "comp").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    blocks = scratch.write(m.groupBy("label", "size", "comp", "blk").applyInPandas(
        centre, f"label {t}, size int, comp long, blk int, radius double, centre array<double>"), f"{name}-blocks")
    pairs = scratch.write(near_blocks(blocks, threshold), f"{name}-pairs")
    side = lambda c, b: [F.col("comp").alias(c), F.col("blk").alias(b), "node", "copies", "unit"]
    left = pairs.join(m.select(*side("ca", "ba")), ["ca", "ba"]).withColumn("right", F.lit(False))
    right = (pairs.filter("ca != cb OR ba != bb").join(m.select(*side("cb", "bb")), ["cb", "bb"]).withColumn("right", F.lit(True)))
    parts = left.unionByName(right).groupBy("ca", "ba", "cb", "bb").applyInPandas(count, "node long, comp long, other long, links long")
    return scratch.write(parts.groupBy("node", "comp", "other").agg(F.sum("links").alias("links")), f"{name}-met")


def met(comps: DataFrame, crowded: DataFrame, classes: DataFrame, threshold: float, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """(comps: node, comp, dense; links: node, links): the ``crowded`` components, which are compared
    in full with each other, joined where they meet."""
    of = classes.select("node", "label", "size", "copies", "unit")
    found = block_links(comps.join(crowded, "comp").join(of, "node"), threshold, scratch, name)
    joined = components(found.filter("comp != other").select(F.col("comp").alias("a"), F.col("other").alias("b")).distinct(), scratch, f"{name}-joined")
    comps = (comps.join(crowded.withColumn("dense", F.lit(True)), "comp", "left")
             .join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("whole")), "comp", "left")
             .select("node", F.coalesce("whole", "comp").alias("comp"), F.coalesce("dense", F.lit(False)).alias("dense")))
    return scratch.write(comps, f"{name}-comps"), found.groupBy("node").agg(F.sum("links").alias("links"))


def recalls(truth: DataFrame, links: DataFrame, comps: DataFrame) -> pd.DataFrame:
    """label, size, all, hit of each audited node (a of ``truth``: a, b, label, size): its links,
    and those confirmed from the lists or within a component that is compared in full."""
    inside = comps.filter("dense")
    c = lambda side: inside.select(F.col("node").alias(side), F.col("comp").alias(f"c_{side}"))
    listed = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumn("listed", F.lit(True))
    t = truth.join(listed, ["a", "b"], "left").join(c("a"), "a", "left").join(c("b"), "b", "left")
    hit = F.coalesce("listed", F.col("c_a") == F.col("c_b"), F.lit(False)).cast("int")
    return t.groupBy("a", "label", "size").agg(F.count("*").alias("all"), F.sum(hit).alias("hit")).toPandas()


def short(audited: pd.DataFrame) -> list:
    """The (label, size) groups whose audited nodes miss the recall, over links or over nodes."""
    return [tuple(getattr(x, "item", lambda x=x: x)() for x in key) for key, g in audited.groupby(["label", "size"])
            if g["hit"].sum() < RECALL * g["all"].sum() or (g["hit"] / g["all"]).mean() < RECALL]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "nndescent")
    label, e = F.col("label"), F.col("embedding")
    rows = vectors.select("vec_id", "label", "embedding", usable(e, label).alias("good"),
                          F.xxhash64("label", "embedding").alias("k1"), F.xxhash64("embedding", "label", F.lit(1)).alias("k2"))
    classes = classes_of(rows, scratch)
    nodes = scratch.write(compact(classes), "nodes")
    k, turn = K, 0
    lists = scratch.write(nearest(first_pairs(nodes).withColumn("fresh", F.lit(True)), k), "lists-0")
    group = classes.select(F.col("node").alias("a"), "label", "size")
    truth = scratch.write(audit(classes, threshold).join(group, "a"), "audit")
    linked = lambda: lists.filter(F.col("s") >= threshold - SLACK).count()
    before = linked()
    while True:
        for _ in range(ROUNDS):
            turn += 1
            known = lists.select(F.col("u").alias("a"), F.col("v").alias("b"), "s", F.lit(False).alias("fresh"))
            found = descend(lists, nodes, k).withColumn("fresh", F.lit(True))
            lists = scratch.write(nearest(known.unionByName(found), k), f"lists-{turn}")
            scratch.drop(f"lists-{turn - 1}")
            after = linked()
            settled = after - before <= SETTLED * after
            before = after
            if settled:
                break
        links = scratch.write(confirmed(lists, classes, threshold), f"links-{turn}")
        comps = components(links, scratch, f"comps-{turn}")
        full = (lists.filter(F.col("s") >= threshold - SLACK).groupBy("u").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
                .select(F.col("u").alias("node")))
        crowded = scratch.write(comps.join(full, "node", "left_semi").select("comp").distinct(), f"crowded-{turn}")
        comps, dense = met(comps, crowded, classes, threshold, scratch, f"met-{turn}")
        audited = recalls(truth, links, comps)
        missed = short(audited)
        if not missed or turn > 3 * ROUNDS:
            break
        k *= 2
    if missed:  # exact: all nodes of these labels are compared, each component with each
        t = classes.schema["label"].dataType.simpleString()
        missed = spark.createDataFrame(missed, f"label {t}, size int")
        every = (classes.join(missed, ["label", "size"], "left_semi").select("node").join(comps.select("node", "comp"), "node", "left")
                 .select("node", F.coalesce("comp", "node").alias("comp")))
        comps = comps.join(every, "node", "left_anti").unionByName(every.withColumn("dense", F.lit(True)))
        crowded = scratch.write(comps.filter("dense").select("comp").distinct(), "crowded-all")
        comps, dense = met(comps.select("node", "comp"), crowded, classes, threshold, scratch, "met-all")
        audited = recalls(truth, links, comps)
    recall = float(audited["hit"].sum() / audited["all"].sum()) if len(audited) else 1.0
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    sparse = (ends.join(comps.filter("NOT dense"), "node")
              .join(classes.select(F.col("node").alias("other"), "copies"), "other")
              .groupBy("node").agg(F.sum("copies").alias("links")))
    named = (classes.select("node", "k1", "k2", "min_id", "copies").join(comps.drop("dense"), "node", "left")
             .join(dense.unionByName(sparse), "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    least = named.groupBy("comp").agg(F.min("min_id").alias("least"))
    named = named.join(least, "comp").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                             F.col("least").alias("component_id"))
    out = rows.select("vec_id", "good", "k1", "k2").join(named, ["k1", "k2"], "left")
    out = out.select("vec_id", F.when(F.col("good"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                     F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    out = out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    return out.withColumn("recall", F.lit(float(recall)))


def op4(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {THRESHOLD}),
r(node, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
c AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON m.node = vec_id LEFT JOIN c ON c.a = vec_id
"""
