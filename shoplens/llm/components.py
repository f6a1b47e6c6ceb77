"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node reachable) for every node of ``edges`` (a, b; whole numbers).

    Each step hangs neighbours onto the least node in sight; the edges end up as stars.  The neighbours of a node are
    only ever reduced to their minimum, combined map-side, so a node with very many edges is no burden.  Every round is
    written to the shared folder.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(lowest, F.col("a") == F.col("u"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = staged(small.filter("a <> b").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
