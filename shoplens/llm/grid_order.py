"""Embedding near-dedup by an epsilon grid order join; exact.

Two unit vectors have a cosine of at least c when they are at most ``epsilon = sqrt(2 - 2 c)`` apart.  The vectors of a
label are rotated to principal axes, cut into grid cells of width epsilon on the leading ones, and sorted by these cells.
Intervals of this order keep the range of each leading axis, a centre and a radius.  Two intervals whose ranges lie more
than epsilon apart on some axis, or whose balls do, are provably distant and skipped; two whose balls cannot hold points
more than epsilon apart are provably near, and all their pairs are links without being looked at.

The join recurses over pairs of intervals: each step is a Spark join of the open pairs with the next finer intervals,
``FAN`` children each, down to blocks of the sorted sequence; open pairs of blocks are joined in tasks, where the same
recursion goes on down to ``LEAF`` vectors, whose cosines are computed.

Copies of a vector lie in few intervals of radius 0, near each other, so a group of copies costs its intervals, not its
pairs.  A vector's links are counted, never listed; of a block pair only a spanning forest of its links leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import ship_code, staged
from shoplens.llm.components import components

COSINE = 0.98
AXES = 8  # leading axes of the grid
SAMPLE = 4096  # vectors that the axes are taken from; any axes give the same result
BLOCK = 1024  # vectors of a block
LEAF = 64
FAN = 8  # children of an interval
SLACK = 1e-9  # of distances that decide without looking at pairs

NODE_BITS = 10  # places within a block
BLOCKS = "label int, part int, seq long, n int, ids binary, no_ids binary, data binary, low array<double>, high array<double>, centre array<double>, radius double"
HEAD = ("n", "low", "high", "centre", "radius")
assert BLOCK <= 1 << NODE_BITS


def can_link() -> Column:
    """Whether a row has a label and a vector that is neither null nor zero, without null or non-finite components."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _keyed(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("no_id"),
                          F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("x"))


def _units(arrays, width: int) -> np.ndarray:
    m = np.zeros((len(arrays), width))
    for i, a in enumerate(arrays):
        m[i, :len(a)] = a
    m /= np.abs(m).max(1, keepdims=True)  # squares of large components stay finite
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _axes(rows: DataFrame, width: int) -> np.ndarray:
    """An orthogonal matrix whose columns are principal axes of a bounded sample, the leading ones first."""
    sample = rows.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE).collect()
    u = _units([r.x for r in sample], width)
    return np.linalg.eigh(np.cov(u, rowvar=False).reshape(width, width) if len(u) > 1 else np.eye(width))[1][:, ::-1]


def _head(m: np.ndarray) -> tuple:
    """Ranges on the leading axes, centre and radius of some vectors."""
    lead, centre = m[:, :AXES], m.mean(0)
    return lead.min(0), lead.max(0), centre, float(np.sqrt(((m - centre) ** 2).sum(1).max()))


def relation(low_a, high_a, centre_a, radius_a, low_b, high_b, centre_b, radius_b, epsilon: float) -> np.ndarray:
    """For pairs of intervals (rows): -1 provably distant, 1 provably near, 0 open."""
    gap = np.maximum(np.maximum(low_b - high_a, low_a - high_b).max(1), 0)
    apart = np.sqrt(((centre_a - centre_b) ** 2).sum(1))
    reach = radius_a + radius_b
    out = np.zeros(len(gap), np.int64)
    out[(gap > epsilon + SLACK) | (apart - reach > epsilon + SLACK)] = -1
    out[apart + reach < epsilon - SLACK] = 1
    return out


def _blocks(rows: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """The sorted sequence in blocks: a row for each, with its vectors on the axes."""
    width, grid = len(axes), min(AXES, len(axes))

    def rotated(batches):
        for batch in batches:
            if len(batch):
                m = _units(batch.x, width) @ axes
                cells = np.floor(m[:, :grid] / epsilon).astype(np.int64)
                yield pd.DataFrame({"vec_id": batch.vec_id, "no_id": batch.no_id, "label": batch.label, "cells": list(cells), "data": [v.tobytes() for v in m]})

    def packed(label: int, part: int, seq: int, held: list) -> tuple:
        ids, no_ids, data = zip(*held)
        low, high, centre, radius = _head(np.frombuffer(b"".join(data), np.float64).reshape(len(ids), width))
        return label, part, seq, len(ids), np.array(ids, np.int64).tobytes(), np.array(no_ids, np.int8).tobytes(), b"".join(data), low, high, centre, radius

    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def cut(batches):
        now, seq, held, part = None, 0, [], 0
        for batch in batches:
            out = []
            for label, part, *row in zip(batch.label, batch.part, batch.vec_id, batch.no_id, batch.data):
                if held and (label != now or len(held) == BLOCK):
                    out.append(packed(now, part, seq, held))
                    seq, held = seq + 1, []
                now = label
                held.append(row)
            if out:
                yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame([packed(now, part, seq, held)], columns=names)

    laid = rows.mapInPandas(rotated, "vec_id long, no_id boolean, label int, cells array<long>, data binary")
    order = ["label", *(F.col("cells")[i] for i in range(grid)), "spread"]
    # equal cells are told apart by their vectors, copies by a number of the row: hot cells are cut like all others
    laid = laid.withColumn("spread", F.xxhash64("data")).withColumn("row", F.xxhash64(F.monotonically_increasing_id()))
    laid = laid.repartitionByRange(*order, "row").sortWithinPartitions(*order, "row").withColumn("part", F.spark_partition_id())
    return laid.select("vec_id", "no_id", "label", "part", "data").mapInPandas(cut, BLOCKS)


def _levels(heads: DataFrame) -> list[DataFrame]:
    """Intervals of 1, FAN, FAN^2 … blocks: label, at (the interval's number) and its head, until a label has at most FAN."""

    def merged(group: pd.DataFrame) -> pd.DataFrame:  # at most FAN rows
        n = group.n.to_numpy(float)
        centres = np.stack(group.centre)
        centre = (centres * n[:, None]).sum(0) / n.sum()
        radius = float((np.sqrt(((centres - centre) ** 2).sum(1)) + group.radius.to_numpy(float)).max())
        return pd.DataFrame([(group.label.iloc[0], group["up"].iloc[0], int(n.sum()), np.stack(group.low).min(0), np.stack(group.high).max(0), centre, radius)],
                            columns=["label", "at", *HEAD])

    out = [heads]
    most = heads.agg(F.max("at")).first()[0]
    while most >= FAN:
        up = out[-1].withColumn("up", F.floor(F.col("at") / FAN).cast("long"))
        out.append(staged(up.groupBy("label", "up").applyInPandas(merged, "label int, at long, n long, low array<double>, high array<double>, centre array<double>, radius double"), "grid-heads"))
        most //= FAN
    return out


def _judged(pairs: DataFrame, heads: DataFrame, epsilon: float) -> DataFrame:
    """label, a, b, kind (1 near, 0 open) of pairs of intervals (a <= b) that are not provably distant."""

    def run(batches):
        for batch in batches:
            if len(batch):
                sides = [np.stack(batch[f"{c}_{s}"]) if c != "radius" else batch[f"{c}_{s}"].to_numpy(float) for s in "ab" for c in HEAD[1:]]
                batch = batch.assign(kind=relation(*sides, epsilon))
                yield batch.loc[batch.kind >= 0, ["label", "a", "b", "kind"]]

    for s in "ab":
        one = heads.select(F.col("label").alias("__l"), F.col("at").alias("__at"), *(F.col(c).alias(f"{c}_{s}") for c in HEAD[1:]))
        pairs = pairs.join(one, (F.col("label") == F.col("__l")) & (F.col(s) == F.col("__at"))).drop("__l", "__at")
    return pairs.mapInPandas(run, "label int, a long, b long, kind int")


def interval_pairs(levels: list[DataFrame], epsilon: float) -> tuple[list[DataFrame], DataFrame]:
    """Near pairs of each level, finest first, and the open pairs of blocks."""
    top = levels[-1].select("label", "at")
    pairs = top.withColumnRenamed("at", "a").join(top.withColumnRenamed("at", "b"), "label").filter("a <= b")  # at most FAN a label
    near: list[DataFrame] = []
    for level in range(len(levels) - 1, -1, -1):
        judged = staged(_judged(pairs, levels[level], epsilon), "grid-pairs")
        near.append(judged.filter("kind = 1").select("label", "a", "b"))
        pairs = judged.filter("kind = 0").select("label", "a", "b")
        if level:
            for s in "ab":
                pairs = pairs.withColumn(s, F.explode(F.sequence(F.col(s) * FAN, F.col(s) * FAN + FAN - 1)))
            pairs = pairs.filter("a <= b")
    return near[::-1], pairs


def _join(a: np.ndarray, b: np.ndarray, same: bool, epsilon: float, cosine: float) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Parts of two sorted blocks with their links as a matrix: the recursion within a task."""
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if same and b1 <= a0:
            continue  # met the other way round
        x, y = a[a0:a1], b[b0:b1]
        heads = [np.asarray(v)[None] for part in (x, y) for v in _head(part)]
        if relation(*heads, epsilon)[0] < 0:
            continue
        if len(x) <= LEAF and len(y) <= LEAF:
            links = x @ y.T >= cosine
            if same:
                links &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
            yield slice(a0, a1), slice(b0, b1), links
            continue
        cuts_a = [(a0, a1)] if len(x) <= LEAF else [(a0, (a0 + a1) // 2), ((a0 + a1) // 2, a1)]
        cuts_b = [(b0, b1)] if len(y) <= LEAF else [(b0, (b0 + b1) // 2), ((b0 + b1) // 2, b1)]
        stack += [(*p, *q) for p in cuts_a for q in cuts_b]


def join_blocks(a: np.ndarray, b: np.ndarray, same: bool, epsilon: float, cosine: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of each vector of two blocks into the other, and a spanning forest of the links; places in b start at len(a)
    unless ``same``."""
    offset = 0 if same else len(a)
    count_a, count_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    root = np.arange(offset + len(b))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    forest = []
    for at_a, at_b, links in _join(a, b, same, epsilon, cosine):
        if not links.any():
            continue
        count_a[at_a] += links.sum(1)
        count_b[at_b] += links.sum(0)
        for i, row in enumerate(links, at_a.start):
            for j in np.flatnonzero(row) + at_b.start + offset:
                p, q = find(i), find(int(j))
                if p != q:
                    root[p] = q
                    forest.append((i, int(j)))
    return count_a, count_b, forest


def _links(open_pairs: DataFrame, blocks: DataFrame, width: int, epsilon: float, cosine: float) -> DataFrame:
    """node, other, n: a link of the spanning forests (other not null), or the number of links of a node in a block pair."""

    def run(batches):
        for batch in batches:
            for na, nb, da, db, same in zip(batch.node_a, batch.node_b, batch.data_a, batch.data_b, batch.same):
                a, b = (np.frombuffer(d, np.float64).reshape(-1, width) for d in (da, db))
                count_a, count_b, forest = join_blocks(a, b, same, epsilon, cosine)
                if same:
                    count_a, count_b = count_a + count_b, count_b[:0]
                node = np.concatenate([na + np.arange(len(a)), nb + np.arange(len(b))])[:len(count_a) + len(count_b)]
                count = np.concatenate([count_a, count_b])
                to = node if not same else na + np.arange(len(a))
                ends = np.array(forest, np.int64).reshape(-1, 2)
                yield pd.DataFrame({"node": np.concatenate([node[count > 0], to[ends[:, 0]]]),
                                    "other": pd.array([None] * int((count > 0).sum()) + to[ends[:, 1]].tolist(), "Int64"),
                                    "n": np.concatenate([count[count > 0], np.zeros(len(ends), np.int64)])})

    pairs = open_pairs
    for s in "ab":
        one = blocks.select(F.col("label").alias("__l"), F.col("at").alias("__at"), F.col("node").alias(f"node_{s}"), F.col("data").alias(f"data_{s}"))
        pairs = pairs.join(one.hint("merge"), (F.col("label") == F.col("__l")) & (F.col(s) == F.col("__at"))).drop("__l", "__at")
    return pairs.withColumn("same", F.col("a") == F.col("b")).mapInPandas(run, "node long, other long, n long")


def link_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, embedding, label): vec_id, n_links (other rows of its label at a cosine
    of ``cosine`` or more), component_id (the smallest vec_id reachable by links, its own included), kept (whether that is
    its own).

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a label link with nothing.
    Vectors shorter than the longest are filled with zeros.  Each row is a vector of its own, also one that repeats a
    vec_id, whose rows are all kept if one is.  A row without vec_id counts as a link, but gives no component its name;
    where a component has no other rows, the name is null and they are kept.  Labels are whole numbers.  Other columns
    are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    epsilon = float(np.sqrt(2 - 2 * cosine))
    fit = staged(_keyed(vectors.filter(can_link())), "grid-vectors")
    width = fit.agg(F.max(F.size("x"))).first()[0]
    alone = vectors.filter(~can_link()).select(F.col("vec_id").cast("long").alias("vec_id"))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if width is None:
        return alone

    made = staged(_blocks(fit, _axes(fit, width), epsilon), "grid-blocks")
    # blocks are numbered within their label: those of a partition follow those of the partitions before
    starts = made.groupBy("label", "part").agg(F.count(F.lit(1)).alias("blocks"), F.min("seq").alias("first"))
    before = Window.partitionBy("label").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = starts.select("label", "part", (F.coalesce(F.sum("blocks").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    node = F.shiftleft(F.col("part").cast("long"), 40) + F.shiftleft(F.col("seq"), NODE_BITS)
    blocks = made.join(starts, ["label", "part"]).withColumn("at", F.col("seq") + F.col("shift")).withColumn("node", node)
    blocks = staged(blocks.drop("part", "seq", "shift"), "grid-numbered")
    levels = _levels(blocks.select("label", "at", F.col("n").cast("long").alias("n"), *HEAD[1:]))
    near, open_pairs = interval_pairs(levels, epsilon)
    found = staged(_links(open_pairs, blocks, width, epsilon, cosine), "grid-links")

    members = blocks.select("label", "at", "node", "n")
    counts = [found.filter("n > 0").select("node", "n")]
    edges = [found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))]
    for level, pairs in enumerate(near):
        # all of a near pair of intervals are links of each other: counted by interval, joined through each block's first
        size = levels[level].select("label", "at", "n")
        sized = pairs.join(size.select("label", F.col("at").alias("a"), F.col("n").alias("n_a")), ["label", "a"]).join(size.select("label", F.col("at").alias("b"), F.col("n").alias("n_b")), ["label", "b"])
        one, other = F.struct(F.col("a").alias("at"), (F.col("n_b") - (F.col("a") == F.col("b")).cast("long")).alias("add")), F.struct(F.col("b").alias("at"), F.col("n_a").alias("add"))
        sides = F.when(F.col("a") == F.col("b"), F.array(one)).otherwise(F.array(one, other))
        adds = sized.select("label", F.inline(sides)).groupBy("label", "at").agg(F.sum("add").alias("add"))
        inside = members.withColumn("up", F.floor(F.col("at") / FAN**level).cast("long"))
        own = inside.join(adds.withColumnRenamed("at", "up"), ["label", "up"])
        counts.append(own.select(F.explode(F.sequence(F.col("node"), F.col("node") + F.col("n") - 1)).alias("node"), F.col("add").alias("n")))
        first = inside.groupBy("label", "up").agg(F.min_by("node", "at").alias("first"))
        joined = pairs.join(first.select("label", F.col("up").alias("a"), F.col("first").alias("fa")), ["label", "a"]).join(first.select("label", F.col("up").alias("b"), F.col("first").alias("fb")), ["label", "b"])
        edges.append(joined.filter("a <> b").select(F.col("fa").alias("a"), F.col("fb").alias("b")))
        tied = own.join(first, ["label", "up"])
        # the two intervals of a near pair are all in one component, so each one's vectors are tied to its first
        edges.append(tied.select(F.col("first").alias("a"), F.explode(F.sequence(F.col("node"), F.col("node") + F.col("n") - 1)).alias("b")).filter("a <> b"))

    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    n_links = union(counts).groupBy("node").agg(F.sum("n").alias("n_links"))
    ties = components(union(edges))

    def listed(batches):
        for batch in batches:
            for node, ids, no_ids in zip(batch.node, batch.ids, batch.no_ids):
                ids = np.frombuffer(ids, np.int64)
                yield pd.DataFrame({"node": node + np.arange(len(ids)), "vec_id": pd.array(ids, "Int64").copy(), "no_id": np.frombuffer(no_ids, np.int8) > 0})

    nodes = blocks.select("node", "ids", "no_ids").mapInPandas(listed, "node long, vec_id long, no_id boolean")
    nodes = staged(nodes.select("node", F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id")).join(n_links, "node", "left").join(ties, "node", "left"), "grid-nodes")
    names = nodes.filter("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("least")).withColumnRenamed("component", "__c")
    named = nodes.join(names, F.col("component") == F.col("__c"), "left")
    named = named.withColumn("component_id", F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least")))
    linked = named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.unionByName(alone)
