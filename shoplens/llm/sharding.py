"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows of each source are shuffled by a seeded hash of id and text and ranked; a row's fractional rank ``(rank + 0.5) / rows of its
source`` spreads every source evenly over [0, 1).  All rows sorted by fractional rank are cut into shards of equal row
counts, so each shard holds each source in its share of the whole, up to a row or two.

Ranks are taken over equal-width buckets of the hash (within a source) and of the fractional rank (over all), with
counted bucket starts: a source with a third of all rows is ranked by many tasks.  Texts are never shuffled, only
their size and checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import bucket_count, hash_bucket, numbered

OVERHEAD = 8  # bytes a stored document takes besides its text


def assign_shards(docs: DataFrame, n_shards: int = 24, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, text_crc32, shard, slot (gapless from 0 in each shard).

    Law ``rows``: shard sizes differ by one row at most.  Null text counts as empty (size 8, checksum 0); a null
    source is a stratum of its own; rows with the same or a null doc_id are each placed; rows alike in id, source,
    size and checksum are interchangeable.  Fewer rows than shards leave shards empty; an empty table gives no rows.
    Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), F.col("source"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("__h"),
    )
    n = docs.count()
    buckets = bucket_count(n)
    tie = [F.col(c) for c in ("__h", "doc_id", "text_crc32", "size")]
    ranked = numbered(rows.withColumn("__b", hash_bucket(F.col("__h"), buckets)), "__b", tie, "__rank", by=("source",), total="__rows")
    ranked = ranked.withColumn("__f", (F.col("__rank") + 0.5) / F.col("__rows"))
    ranked = ranked.withColumn("__fb", F.floor(F.col("__f") * buckets))
    placed = numbered(ranked, "__fb", [F.col("__f"), F.col("source"), *tie], "__g")
    shard = F.expr(f"__g * {n_shards} div {max(n, 1)}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "source", "size", "text_crc32", "shard",
        F.expr(f"__g - (shard * {n}L + {n_shards - 1}) div {n_shards}").cast("long").alias("slot"),
    )
