"""Tables of merged runs: what each micro-batch adds, kept in few files per group (STR2, and the dashboard's roll-ups).

A group (a day and bucket of the seen set, a month of a roll-up) is a list of runs, each the rows of one batch or of
several merged ones, stored under ``data/batch=<n>/grp=<group>``.  A batch adds a run of level 0 to the groups it touches;
``fanout`` runs of one level are merged into one of the next, by the same function that combines a batch's own rows.  So
a group of n batches is read from at most ``fanout`` runs a level, ``log n`` levels, and a row is rewritten once a level.

Which runs make up which group stands in the table's head (see :mod:`shoplens.sinks.keyed_table`).  A batch that is
written again starts from the head before it and replaces its own folders, so replays change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shoplens.sinks.keyed_table import head, write_head

FANOUT = 8

Merge = Callable[[DataFrame], DataFrame]


def planned(runs: list[list[int]], batch_id: int, fanout: int = FANOUT) -> tuple[list[list[int]], list[int]]:
    """The runs ([batch, level], oldest first) of a group after a batch was added, and the batches merged into its run."""
    level, due = 0, []
    runs = list(runs)
    while len(runs) >= fanout - 1 and all(r[1] == level for r in runs[len(runs) - fanout + 1:]):
        due += [r[0] for r in runs[len(runs) - fanout + 1:]]
        runs, level = runs[:len(runs) - fanout + 1], level + 1
    return [*runs, [batch_id, level]], due


def _read(spark: SparkSession, path: str, schema: StructType | str, folders: list[str]) -> DataFrame:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    schema = StructType([*(f for f in schema.fields if f.name != "grp"), StructField("grp", StringType())])
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders) if folders else spark.createDataFrame([], schema)


def append_run(rows: DataFrame, path: str, batch_id: int, merge: Merge, fanout: int = FANOUT) -> None:
    """Adds a batch: ``rows`` have a text column ``grp``; ``merge`` combines rows of the same columns (a sum or a distinct by
    key, ``grp`` among the keys).  An empty batch changes nothing but the head's batch number."""
    spark, path = rows.sparkSession, path.rstrip("/")
    now, slot = head(spark, path, before=batch_id)
    groups = now["groups"] if now else {}
    fresh = merge(rows).persist()
    try:
        touched = [r["grp"] for r in fresh.select("grp").distinct().collect()]  # groups of one batch
        plan = {g: planned(groups.get(g, []), batch_id, fanout) for g in touched}
        folders = [f"{path}/data/batch={n}/grp={g}" for g, (_, due) in plan.items() for n in due]
        out = fresh
        if folders:
            out = merge(fresh.unionByName(_read(spark, path, rows.schema, folders).select(*fresh.columns)))
        if touched:
            (out.hint("rebalance", "grp").withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch", "grp").parquet(f"{path}/data"))
    finally:
        fresh.unpersist()
    write_head(spark, path, slot, {"batch": batch_id, "groups": groups | {g: runs for g, (runs, _) in plan.items()}})


def read_runs(spark: SparkSession, path: str, schema: StructType | str, groups: Iterable[str] | None = None, before: int | None = None) -> DataFrame:
    """The rows of the groups asked for (None: all), with their ``grp``: only their runs' folders are listed and read.  ``before`` gives the table
    as it was before that batch; empty if nothing was written yet."""
    path = path.rstrip("/")
    now, _ = head(spark, path, before)
    held = now["groups"] if now else {}
    return _read(spark, path, schema, [f"{path}/data/batch={n}/grp={g}" for g in (held if groups is None else groups) for n, _ in held.get(g, [])])


def summed(*keys: str) -> Merge:
    """Roll-ups: every other column is summed by ``grp`` and ``keys``."""
    def merge(rows: DataFrame) -> DataFrame:
        by = ["grp", *keys]
        return rows.groupBy(*by).agg(*(F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in by)).select(*rows.columns)
    return merge


def distinct(rows: DataFrame) -> DataFrame:
    return rows.distinct()
