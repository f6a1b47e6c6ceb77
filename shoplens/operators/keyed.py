"""Last-write-wins by key: the read side of every keyed upsert (user dimension, alert and sale documents).

``max(struct(order..., rest...))`` is a partial aggregate: each task keeps one row per key before the shuffle,
so a key written millions of times costs one row per task, not a group gathered in one place.  Ties on the order
columns are broken by the remaining columns, so the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_latest")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, "_latest.*")
            .select(*df.columns))
