"""Exact top-k search by inner product with a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it.  The distances of a pivot are cut into rings (sorted
annuli); a ring's vectors are packed into blocks of bounded size, and its distance range and greatest norm are kept.
For a query q and a vector v of a ring, the triangle inequality gives ``|q - v| >= d``, the gap between q's distance to
the pivot and the ring's range, so ``q.v = (|q|^2 + |v|^2 - |q - v|^2) / 2 <= (|q|^2 + norm^2 - d^2) / 2``.  A ring keeps
its range of distances to every other pivot, too, and the widest of these gaps counts.

Each query first searches its best rings until they hold enough vectors, which gives the score its k-th best must at
least have; then its search expands over all rings in the order of their bounds and stops at the first bound below that
score.  All arithmetic on scores is on whole numbers, so the result is exact; bounds get a little slack for rounding.

Queries travel in blocks, one per ring they still need; vectors are packed once.  A ring of any size, say of one vector
repeated a million times, is split into as many blocks as it needs, all with the ring's bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import ship_code, staged

PIVOTS = 32
RINGS = 64  # per pivot, at most
RING_LEAST = 512  # vectors of a ring, unless its pivot has fewer
BLOCK = 2048  # vectors of a block
QUERY_BLOCK = 512
FIRST_SEARCH = 512  # vectors that the first search looks at, at least
PIVOT_SAMPLE = 2048  # vectors that the pivots are chosen from
EXACT = 2.0**53
SAFE = 2.0**62  # whole numbers up to here leave room for the rounding of their estimate
NO_LIMIT = -(1 << 63)

PAIR = "query_row long, query_id long, row long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and q, the components ``floor(scale * x)``; rows alike in both are one row, another vector of the same vec_id
    is a row of its own.  Vectors that are null or hold null, infinite or NaN components, and rows without vec_id, are left
    out; components beyond 64 bits are the nearest long."""
    x = F.col("embedding").cast("array<double>")
    fit = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(fit)
    return rows.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda v: F.floor(v * scale).cast("long")).alias("q")).distinct()


def numbered_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """:func:`whole_vectors` as a written table, with ``row``, a number of each row's own."""
    return staged(whole_vectors(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "topk-rows")


def _matrix(arrays, width: int) -> np.ndarray:
    out = np.zeros((len(arrays), width), np.int64)
    for i, a in enumerate(arrays):
        out[i, :len(a)] = a
    return out


def _pivots(rows: DataFrame, width: int, pivots: int) -> np.ndarray:
    """Pivots far from each other, from a sample of ``PIVOT_SAMPLE`` vectors, the first by a hash of their id."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    points = _matrix([r.q for r in sample], width).astype(float)
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    m = m.astype(float)
    return np.sqrt(np.maximum((m * m).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * m @ pivots.T, 0))


def _merged(thin: pd.DataFrame) -> list[int]:
    """For each thin ring, in order, the first ring of the annulus it joins: neighbours of one pivot are put together
    until they hold ``RING_LEAST`` vectors."""
    out, pivot, first, held = [], None, 0, 0
    for ring, n in zip(thin.ring.tolist(), thin.n.tolist()):
        if ring // RINGS != pivot or held >= RING_LEAST:
            pivot, first, held = ring // RINGS, ring, 0
        held += n
        out.append(first)
    return out


class Rings:
    """The index's head: one entry per ring that holds vectors, at most ``PIVOTS * RINGS``."""

    def __init__(self, pivots: np.ndarray, table: pd.DataFrame, width: int, ranges: tuple[np.ndarray, np.ndarray] | None = None):
        """``ranges``: least and greatest distance of each ring (rows) to each pivot (columns)."""
        self.ranges = ranges
        self.pivots, self.width = pivots, width
        self.ring = table.ring.to_numpy(np.int64)
        self.pivot = self.ring // RINGS
        self.low, self.high = table.low.to_numpy(float), table.high.to_numpy(float)
        self.norm2, self.n = table.norm2.to_numpy(float), table.n.to_numpy(np.int64)
        self.blocks = -(-self.n // BLOCK)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and ring, a score that no vector of the ring exceeds."""
        to_pivots = _distances(queries, self.pivots)
        gap = self._gap(to_pivots[:, self.pivot], self.low, self.high)
        for k, (low, high) in enumerate(zip(*(x.T for x in self.ranges)) if self.ranges else ()):
            gap = np.maximum(gap, self._gap(to_pivots[:, [k]], low, high))
        q2 = (queries.astype(float) ** 2).sum(1)[:, None]
        top = (q2 + self.norm2[None, :] - gap * gap) / 2
        return np.maximum(top + 1e-9 * (q2 + self.norm2[None, :]) + 1e-6, float(NO_LIMIT))

    @staticmethod
    def _gap(d: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return np.maximum(np.maximum(low - d, d - high) - 1e-6 * (1 + d + high), 0)


def _scores(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, in double precision where that is exact; those beyond 64 bits are the nearest long."""
    if block.size == 0 or queries.size == 0:
        return np.zeros((len(queries), len(block)), np.int64)
    most = np.abs(queries.astype(float)).max() * np.abs(block.astype(float)).max() * max(1, queries.shape[1])
    if most < EXACT:
        return (queries.astype(float) @ block.astype(float).T).astype(np.int64)
    if most < SAFE:
        return queries @ block.T
    wide = queries.astype(object) @ block.astype(object).T
    return np.clip(wide, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _search(batches: Iterator[pd.DataFrame], width: int, k: int) -> Iterator[pd.DataFrame]:
    """Rows hold a block of vectors and a block of queries, with the scores their k-th best have at least; ``ids`` and
    ``qids`` are pairs (row, vec_id)."""
    for batch in batches:
        for ids, data, qids, qdata, least in zip(batch.ids, batch.data, batch.qids, batch.qdata, batch.least):
            own, ids = np.frombuffer(ids, np.int64).reshape(-1, 2).T
            block, queries = np.frombuffer(data, np.int64).reshape(-1, width), np.frombuffer(qdata, np.int64).reshape(-1, width)
            scores, least = _scores(queries, block), np.frombuffer(least, np.int64)
            found = []
            for row, (qrow, qid), floor in zip(scores, np.frombuffer(qids, np.int64).reshape(-1, 2), least):
                fit = np.flatnonzero((row >= floor) & (own != qrow))
                if len(fit) > k:
                    fit = fit[np.lexsort((own[fit], ids[fit], -row[fit]))[:k]]
                found.append((np.full(len(fit), qrow), np.full(len(fit), qid), own[fit], ids[fit], row[fit]))
            yield pd.DataFrame({c: np.concatenate(x) for c, x in zip(("query_row", "query_id", "row", "vec_id", "score"), zip(*found))})


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class Index:
    """The rows of a table from :func:`numbered_vectors` in blocks, each of one ring, and the rings."""

    def __init__(self, rows: DataFrame, width: int, pivots: int = PIVOTS):
        spark, self.width = rows.sparkSession, width
        ship_code(spark)
        points = _pivots(rows, width, pivots)

        def keyed(batches):
            for batch in batches:
                if not len(batch):
                    continue
                m = _matrix(batch.q, width)
                d = _distances(m, points)
                nearest = d.argmin(1)
                yield pd.DataFrame({"row": batch.row, "vec_id": batch.vec_id, "pivot": nearest, "distance": d[np.arange(len(d)), nearest],
                                    "norm2": (m.astype(float) ** 2).sum(1), "distances": list(d.astype(np.float32)), "data": [v.tobytes() for v in m]})

        points_at = rows.select("row", "vec_id", "q").mapInPandas(
            keyed, "row long, vec_id long, pivot int, distance double, norm2 double, distances array<float>, data binary")
        points_at = staged(points_at, "topk-keyed")
        reach = points_at.groupBy("pivot").agg(F.max("distance").alias("reach"))  # a row per pivot
        ring = F.col("pivot") * RINGS + F.least(F.floor(F.col("distance") / F.col("reach") * RINGS), F.lit(RINGS - 1))
        ringed = points_at.join(F.broadcast(reach), "pivot").withColumn("ring", F.coalesce(F.when(F.col("reach") > 0, ring), F.col("pivot") * RINGS).cast("long"))
        at = range(len(points))
        thin = ringed.groupBy("ring").agg(
            F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("norm2").alias("norm2"), F.count(F.lit(1)).alias("n"),
            *(F.min(F.col("distances")[i]).alias(f"low{i}") for i in at), *(F.max(F.col("distances")[i]).alias(f"high{i}") for i in at),
        ).orderBy("ring").toPandas()  # at most PIVOTS * RINGS rows
        thin["merged"] = _merged(thin)
        by = thin.groupby("merged")
        ranges = tuple(getattr(by[[f"{which}{i}" for i in at]], how)().to_numpy(float) for which, how in (("low", "min"), ("high", "max")))
        self.head = Rings(points, by.agg(low=("low", "min"), high=("high", "max"), norm2=("norm2", "max"), n=("n", "sum"))
                          .reset_index().rename(columns={"merged": "ring"}), width, ranges)
        block_count = dict(zip(self.head.ring.tolist(), self.head.blocks.tolist()))
        places = spark.createDataFrame([(int(r), int(m), int(block_count[m])) for r, m in zip(thin.ring, thin.merged)], "ring long, merged long, blocks long")
        # every block has about BLOCK vectors, however many its ring has
        blocks = ringed.join(F.broadcast(places), "ring").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))).withColumn("ring", F.col("merged"))
        blocks = blocks.groupBy("ring", "block").agg(F.sort_array(F.collect_list(F.struct("row", "vec_id", "data"))).alias("rows"))

        def pack(batches):
            for batch in batches:
                yield pd.DataFrame({"ring": batch.ring, "block": batch.block,
                                    "ids": [np.array([(r["row"], r["vec_id"]) for r in x], np.int64).tobytes() for x in batch.rows],
                                    "data": [b"".join(bytes(r["data"]) for r in x) for x in batch.rows]})

        self.blocks = staged(blocks.mapInPandas(pack, "ring long, block long, ids binary, data binary"), "topk-blocks")

    def found(self, queries: DataFrame, k: int, first: bool) -> DataFrame:
        width = self.width
        asked = _asked(queries, self.head, first).hint("merge").join(self.blocks, ["ring", "block"])
        return _best(asked.mapInPandas(lambda b: _search(b, width, k), PAIR), k)

    def limited(self, queries: DataFrame, k: int) -> DataFrame:
        """``queries`` with ``least``, a score that their k-th best have at least: the k-th best of some rows."""
        first = self.found(queries.select("row", "vec_id", "q", F.lit(NO_LIMIT).alias("least")), k, first=True)
        limits = first.groupBy("query_row").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
        limits = limits.select(F.col("query_row").alias("row"), "least")
        return staged(queries.join(limits, "row", "left").select("row", "vec_id", "q", F.coalesce("least", F.lit(NO_LIMIT)).alias("least")), "topk-limits")

    def searched(self, limited: DataFrame) -> DataFrame:
        """How many vectors the search of each query looks at once it has its limit: query_id, searched."""
        head, width = self.head, self.width

        def run(batches):
            for batch in batches:
                if len(batch):
                    need = head.bounds(_matrix(batch.q, width)) >= batch.least.to_numpy(float)[:, None]
                    yield pd.DataFrame({"query_id": batch.vec_id, "searched": (need * head.n).sum(1)})

        return limited.mapInPandas(run, "query_id long, searched long")


def widest(*tables: DataFrame) -> int | None:
    """The greatest number of components; None if some table is empty."""
    widths = [t.agg(F.max(F.size("q"))).first()[0] for t in tables]
    return None if None in widths else max(*widths, 1)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, pivots: int = PIVOTS) -> DataFrame:
    """For each query (row, vec_id, q), its k best rows by inner product, ties to the smaller vec_id: query_id, rank, vec_id,
    score.  The query's own ``row`` is left out.  Scores beyond 64 bits are the nearest long, and tie.

    ``rows`` is a table from :func:`numbered_vectors`, ``queries`` are rows of it, or have ``row`` numbers that it lacks;
    vectors shorter than the longest are filled with zeros.  Of two queries with one vec_id each has ranks from 1.  With
    fewer than k other rows, all are returned.  Empty tables give no rows.
    """
    width = widest(rows, queries)
    if width is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = Index(rows, width, pivots)
    found = index.found(index.limited(queries, k), k, first=False)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _asked(queries: DataFrame, head: Rings, first: bool) -> DataFrame:
    """Blocks of queries for each vector block they must see: ring, block, qids, qdata, least."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                part = batch.iloc[at:at + QUERY_BLOCK]
                m = _matrix(part.q, head.width)
                bounds, least = head.bounds(m), part.least.to_numpy(np.int64)
                if first:  # the best rings, until they hold enough vectors; of a large ring one block
                    order = np.argsort(-bounds, axis=1, kind="stable")
                    held = np.cumsum(np.minimum(head.n, BLOCK)[order], axis=1)
                    need = np.zeros_like(bounds, bool)
                    upto = (held < FIRST_SEARCH).sum(1) + 1
                    for i, n in enumerate(upto):
                        need[i, order[i, :n]] = True
                else:
                    need = bounds >= least[:, None].astype(float)
                ids = part[["row", "vec_id"]].to_numpy(np.int64)
                rows = []
                for j in np.flatnonzero(need.any(0)):
                    of = need[:, j]
                    packed = (ids[of].tobytes(), m[of].tobytes(), least[of].tobytes())
                    rows += [(int(head.ring[j]), b) + packed for b in range(1 if first else int(head.blocks[j]))]
                for i in range(0, len(rows), 64):
                    yield pd.DataFrame(rows[i:i + 64], columns=["ring", "block", "qids", "qdata", "least"])

    asked = queries.select("row", "vec_id", "q", "least").repartition("row")
    return asked.mapInPandas(run, "ring long, block long, qids binary, qdata binary, least binary")


def neighbours(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """The k best rows of each row whose vec_id is divisible by ``every``, against all rows."""
    rows = numbered_vectors(vectors, scale)
    return top_k(rows, rows.filter(F.col("vec_id") % every == 0), k)


def searched_share(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64) -> float:
    """The share of all vectors that a query's search looks at after the first one, as the mean over the queries: 1.0 where
    the bounds rule nothing out (also for empty tables)."""
    rows = numbered_vectors(vectors, scale)
    queries = rows.filter(F.col("vec_id") % every == 0)
    width = widest(rows, queries)
    if width is None:
        return 1.0
    index = Index(rows, width)
    mean = index.searched(index.limited(queries, k)).agg(F.avg("searched")).first()[0]
    return float(mean) / float(index.head.n.sum())
