"""Mixing sources to target weights by Pfair scheduling.

Each source is shuffled by a seeded hash and cut into blocks.  With weight ``w`` its block ``j`` is released at slot
``floor(j / w)`` and due by slot ``ceil((j + 1) / w)``; earliest deadline first among released blocks fills one slot
after the other.  As the weights sum to one, every block lands inside its window, so before any slot each source is
less than one block from its target share.

The weights are exact fractions, so this holds against the weights as given, over any number of blocks.  One task runs
through the schedule as a stream - a step per block of ``BLOCK_ROWS`` rows, with one entry per source in memory - and
Spark joins its table of blocks to the rows.  A source that has run out leaves the schedule; the others keep their
windows.  Every row is placed exactly once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import bucket_count, hash_bucket, named, numbered, ship_code, staged

BLOCK_ROWS = 16
PERIOD = 1024
ALPHA = 0.7
BATCH = 20_000  # blocks


def quantised(weights: dict, period: int) -> dict:
    """Weights as whole slots of a period: at least one each, the rest by largest remainder."""
    if not weights:
        return {}
    whole = sum(weights.values())
    spare = period - len(weights)
    exact = {s: Fraction(w) / Fraction(whole) * spare for s, w in weights.items()}
    slots = {s: 1 + int(x) for s, x in exact.items()}
    left = period - sum(slots.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], str(s)))[:left]:
        slots[s] += 1
    return slots


def pfair(slots: dict) -> list[tuple]:
    """(source, block, release, deadline, slot) over one period of ``sum(slots)`` slots, earliest deadline first."""
    return list(schedule(slots, slots))


def target_weights(counts: dict, alpha: float = ALPHA) -> dict:
    """Each source's share to the power ``alpha``: below 1, small sources gain."""
    return {s: float(n) ** alpha for s, n in counts.items()}


def whole_weights(counts: dict, weights: dict | None = None, period: int | None = None) -> dict:
    """Whole numbers in the exact proportions of the weights; see :func:`mix`."""
    given = target_weights(counts) if weights is None else {s: w for s, w in weights.items() if s in counts and w > 0}
    lacking = counts.keys() - given.keys()
    least = max(period or PERIOD, 8 * len(counts))
    if period:
        return quantised(given, least - len(lacking)) | {s: 1 for s in lacking}
    exact = {s: Fraction(w) for s, w in given.items()}
    one = sum(exact.values()) / (least - len(lacking)) or Fraction(1)
    exact |= {s: one for s in lacking}
    whole = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * whole) for s, w in exact.items()}


def schedule(blocks: dict, weights: dict) -> Iterator[tuple]:
    """(source, block, release, deadline, slot) of ``blocks[source]`` blocks of each source, slot by slot, earliest
    deadline first among released blocks; ``weights`` are whole numbers."""
    whole = sum(weights.values())
    names = sorted(blocks, key=lambda s: (s is None, str(s)))
    later = [(0, k) for k, s in enumerate(names) if blocks[s]]  # (release, source) of each source's next block
    ready, done, t = [], [0] * len(names), 0
    while later or ready:
        if not ready:
            t = max(t, later[0][0])
        while later and later[0][0] <= t:
            release, k = heapq.heappop(later)
            heapq.heappush(ready, (-(-(done[k] + 1) * whole // weights[names[k]]), k, release))
        deadline, k, release = heapq.heappop(ready)
        yield names[k], done[k], release, deadline, t
        done[k] += 1
        if done[k] < blocks[names[k]]:
            heapq.heappush(later, (done[k] * whole // weights[names[k]], k))
        t += 1


def mix(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS, period: int | None = None,
        seed: int = 23, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` and source, with: block (in its source), release, deadline, slot (in slots) and position
    (gapless from 0, the mixed order).

    ``weights`` maps sources to positive numbers; None takes :func:`target_weights` of the row counts over all rows.
    They are followed exactly; ``period`` rounds them to multiples of ``1 / period`` first (each source at least one).
    Sources of the table that ``weights`` lacks get one slot in ``period``, or else in ``PERIOD`` (in eight times the
    number of sources, if that is more); null is a source like any other.  Within a source the order is by a seeded hash
    of doc_id and text, then doc_id, then the text's hash; rows alike in these are interchangeable.  Null texts and ids take
    part.  An empty table gives no rows.
    """
    ship_code(docs.sparkSession)
    counts = staged(docs.groupBy("source").count(), "mixed-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = {s: int(c) for batch in batches for s, c in zip(batch.source.astype(object).where(batch.source.notna(), None), batch["count"])}
        rows, start = [], 0
        for s, block, release, deadline, slot in schedule({s: -(-c // block_rows) for s, c in n.items()}, whole_weights(n, weights, period)):
            rows.append((s, block, release, deadline, slot, start))
            start += min(block_rows, n[s] - block * block_rows)
            if len(rows) == BATCH:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        yield pd.DataFrame(rows, columns=columns)

    columns = ["__s", "__block", "release", "deadline", "slot", "__start"]
    table = counts.repartition(1).mapInPandas(run, "__s string, __block long, release long, deadline long, slot long, __start long")
    table = staged(table, "mixed-schedule")
    rows = docs.select(*carry, *({"source"} - set(carry)), F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("__h"),
                       F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__th"))
    rows = rows.withColumn("__b", hash_bucket(F.col("__h"), bucket_count(total)))
    ranked = numbered(rows, "__b", [F.col("__h"), F.col("__id"), F.col("__th")], "__rank", by=("source",))
    ranked = ranked.withColumn("block", F.expr(f"__rank div {block_rows}"))
    placed = ranked.join(table, F.col("source").eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__block")))
    return placed.select(*carry, *({"source"} - set(carry)), "block", "release", "deadline", "slot",
                         (F.col("__start") + F.col("__rank") % block_rows).alias("position"))


def in_mixed_order(docs: DataFrame, **how) -> DataFrame:
    """All rows and columns of ``docs``, laid out in mixed order: a range of positions per file, sorted inside it.

    Positions are found without the texts, which are shuffled twice only: to meet their positions, and into their order.
    Rows alike in doc_id and text lie together, at the first of their positions.
    """
    keyed = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("key_hash"))
    places = mix(keyed, carry=("doc_id", "key_hash"), **how).groupBy("doc_id", "key_hash").agg(F.min("position").alias("place"))
    places = staged(places.withColumnRenamed("doc_id", "key_id"), "mixed-places")
    rows = docs.select(F.struct(*named(docs)).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"))
    found = rows.join(places, (F.col("th") == F.col("key_hash")) & F.col("id").eqNullSafe(F.col("key_id")))
    return found.repartitionByRange("place").sortWithinPartitions("place").select("row.*")
