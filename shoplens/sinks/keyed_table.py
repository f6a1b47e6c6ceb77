"""A latest-per-key table in hash buckets (DIM1 / SNK6): a write touches, and a lookup reads, only the buckets of its keys.

Rows are stored under ``data/batch=<n>/bucket=<b>``.  A bucket is a short list of batches: a write adds its rows to the
buckets they fall in, and a bucket with ``MERGE_AT`` batches is rewritten as one, with the latest row of each key.  Which
batches make up which bucket stands in a small head file, one row of at most ``n_buckets`` entries; there are two,
written in turn, so a reader always finds a whole one, and the write that dies leaves the table as it was.

A batch that is written again starts from the head before it and replaces its own folder, so replays change nothing.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shoplens.operators.keyed import latest_by_key

N_BUCKETS = 64
MERGE_AT = 8  # batches of a bucket


def bucket_of(keys: list[str] | tuple[str, ...], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")


def _slot(path: str, slot: int) -> str:
    return f"{path.rstrip('/')}/head-{slot}"


def _read_slot(spark: SparkSession, path: str, slot: int) -> dict | None:
    try:
        found = [r["value"] for r in spark.read.text(_slot(path, slot)).collect()]  # one line
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(found[0]) if found else None  # empty: a write of the head died


def head(spark: SparkSession, path: str, before: int | None = None) -> tuple[dict | None, int]:
    """The newest head, of batches under ``before`` if given, and the slot that a new one goes to."""
    heads = [(_read_slot(spark, path, slot), slot) for slot in (0, 1)]
    fit = [(h, slot) for h, slot in heads if h is not None and (before is None or h["batch"] < before)]
    if not fit:
        return None, 0
    newest, slot = max(fit, key=lambda x: x[0]["batch"])
    return newest, 1 - slot


def write_head(spark: SparkSession, path: str, slot: int, made: dict) -> None:
    spark.createDataFrame([(json.dumps(made),)], "value string").coalesce(1).write.mode("overwrite").text(_slot(path, slot))


def _folders(path: str, buckets: dict[str, list[int]], wanted) -> list[str]:
    return [f"{path.rstrip('/')}/data/batch={n}/bucket={b}" for b in wanted for n in buckets.get(str(b), [])]


def _stored(spark: SparkSession, path: str, schema: StructType, buckets: dict[str, list[int]], wanted) -> DataFrame:
    """All stored versions in the buckets ``wanted``: only their folders are listed and read."""
    folders = _folders(path, buckets, wanted)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def write_keyed(rows: DataFrame, path: str, batch_id: int, keys: tuple[str, ...], order: tuple[str, ...],
                n_buckets: int = N_BUCKETS, merge_at: int = MERGE_AT) -> None:
    """Adds a batch of versions: each key's latest by ``order``.  ``n_buckets`` holds for the table's life (the head's own
    counts once there is one).  Null keys are keys.  An empty batch changes nothing but the head's batch number."""
    spark = rows.sparkSession
    now, slot = head(spark, path, before=batch_id)
    now = now or {"batch": -1, "n_buckets": n_buckets, "buckets": {}}
    n_buckets, buckets = now["n_buckets"], now["buckets"]
    fresh = latest_by_key(rows, keys, order).withColumn("bucket", bucket_of(keys, n_buckets)).persist()
    try:
        touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # n_buckets at most
        due = [b for b in touched if len(buckets.get(str(b), [])) + 1 >= merge_at]
        out = fresh
        if due:
            old = _stored(spark, path, rows.schema, buckets, due).withColumn("bucket", bucket_of(keys, n_buckets))
            out = latest_by_key(fresh.unionByName(old), ["bucket", *keys], order)
        if touched:
            (out.hint("rebalance", "bucket").withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(f"{path.rstrip('/')}/data"))
    finally:
        fresh.unpersist()
    buckets = buckets | {str(b): [batch_id] if b in due else [*buckets.get(str(b), []), batch_id] for b in touched}
    write_head(spark, path, slot, {"batch": batch_id, "n_buckets": n_buckets, "buckets": buckets})


def read_keyed(spark: SparkSession, path: str, schema: StructType, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The whole table: the latest row of each key; empty if nothing was written yet."""
    now, _ = head(spark, path)
    wanted = [] if now is None else sorted(int(b) for b in now["buckets"])
    return latest_by_key(_stored(spark, path, schema, now["buckets"] if now else {}, wanted), keys, order)


def lookup(asked: DataFrame, path: str, schema: StructType, keys: tuple[str, ...], order: tuple[str, ...], before: int | None = None) -> DataFrame:
    """The latest rows of the buckets that the keys in ``asked`` fall in (columns named as ``keys``): what a join with
    ``asked`` needs.  ``before`` gives the table as it was before that batch.  Empty if nothing was written yet."""
    spark = asked.sparkSession
    now, _ = head(spark, path, before)
    if now is None:
        return spark.createDataFrame([], schema)
    found = asked.select(bucket_of(keys, now["n_buckets"]).alias("bucket")).distinct().collect()  # n_buckets at most
    stored = _stored(spark, path, schema, now["buckets"], sorted(r["bucket"] for r in found))
    # only asked keys are folded: the others of their buckets are dropped before the shuffle by key
    return latest_by_key(stored.join(asked.select(*keys).distinct(), list(keys), "left_semi").select(*stored.columns), keys, order)


def exists(spark: SparkSession, path: str) -> bool:
    return head(spark, path)[0] is not None


def with_arrival(schema: StructType) -> StructType:
    """``schema`` with the columns that a topic's messages are ordered by."""
    from pyspark.sql.types import IntegerType, TimestampType
    return StructType([*schema.fields, StructField("timestamp", TimestampType()), StructField("partition", IntegerType()), StructField("offset", LongType())])
