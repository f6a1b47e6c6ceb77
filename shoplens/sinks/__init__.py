"""Sinks: partitioned tables, keyed documents (upsert by id), topic fan-out, raw log archive, previews.

Upsert without a table format: every write stores rows with ``doc_id`` under its own ``batch_id`` folder; readers see
the latest row per ``doc_id`` (``latest_documents``); ``compact`` rewrites a folder to that view.  Writing the same
batch twice replaces that batch's folder, so retried jobs and replayed micro-batches are harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.columns import record_json
from shoplens.operators.dau import LOG_COLUMNS
from shoplens.operators.keyed import latest_by_key

DAU_TABLE_COLUMNS = LOG_COLUMNS + ("logdate", "loghour", "ts")


def _by_day(df: DataFrame, day_col: str) -> DataFrame:
    """Cluster rows by their day before a day-partitioned write, so each task writes few day folders (not one file
    per day per task).  ``rebalance`` lets AQE split a day that holds a large share of all rows over several tasks
    and merge small days, so no single task writes a hot day alone."""
    return df.hint("rebalance", day_col)


def write_dau_table(dau_rows: DataFrame, path: str, mode: str = "append") -> None:
    """SNK1: DAU rows (11 columns) partitioned by ``logdate`` so a day's dashboard reads one folder."""
    _by_day(dau_rows.select(*DAU_TABLE_COLUMNS), "logdate").write.mode(mode).partitionBy("logdate").parquet(path)


def write_dau_batch(dau_rows: DataFrame, path: str, batch_id: int) -> None:
    """SNK1 for one micro-batch: rows stored under ``logdate=<d>/batch_id=<n>``; writing the same batch again
    replaces only that batch's folders (dynamic partition overwrite), so a replayed batch changes nothing."""
    out = dau_rows.select(*DAU_TABLE_COLUMNS).withColumn("batch_id", F.lit(batch_id).cast("long"))
    (_by_day(out, "logdate").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("logdate", "batch_id").parquet(path))


def read_dau_table(spark: SparkSession, path: str) -> DataFrame:
    """Read side of SNK1: one row per (mid, logdate) even if a device-day was appended twice (earliest wins)."""
    from shoplens.operators.dau import first_log_per_device
    return first_log_per_device(spark.read.parquet(path).select(*DAU_TABLE_COLUMNS))


def read_dau_times(spark: SparkSession, path: str) -> DataFrame:
    """The DAU table as (mid, logdate, ts, loghour), one row per device-day: what counts by day and hour need, read from
    two columns and the partition."""
    from shoplens.operators.dau import first_times
    return first_times(spark.read.parquet(path).select("mid", F.col("logdate").cast("string").alias("logdate"), "ts"))


def write_order_table(orders_clean: DataFrame, path: str, mode: str = "append") -> None:
    """SNK2: all order fields, names upper-cased, partitioned by ``CREATE_DATE``."""
    from shoplens.operators.gmv import table_columns
    _by_day(table_columns(orders_clean), "CREATE_DATE").write.mode(mode).partitionBy("CREATE_DATE").parquet(path)


def upsert_documents(docs: DataFrame, path: str, batch_id: int, partition_by: str | None = None) -> None:
    """SNK3 / SNK4 / SNK9: write keyed documents as batch ``batch_id``; same id → the later batch wins on read.

    Each batch owns the folder ``batch_id=<n>`` and replaces it (dynamic partition overwrite), so writing a batch
    again — a retried job, a replayed micro-batch — gives exactly the same stored rows.  Documents without an id are
    kept as they are and never overwritten.  Empty input writes nothing.
    """
    out = docs.withColumn("batch_id", F.lit(batch_id).cast("long"))
    parts = ([partition_by] if partition_by else []) + ["batch_id"]
    (_by_day(out, parts[0]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def documents_from_json(messages: DataFrame, schema, id_col: str = "doc_id") -> DataFrame:
    """SNK9, literal-JSON form: documents given as JSON text (``value``) plus an optional id column, typed by
    ``schema`` before the keyed write."""
    from pyspark.sql.types import StructType
    parsed = F.from_json(F.col("value"), schema if isinstance(schema, StructType) else schema)
    keep = [id_col] if id_col in messages.columns else []
    out = messages.select(*keep, parsed.alias("d")).select(*keep, "d.*")
    if id_col not in out.columns:
        out = out.withColumn(id_col, F.lit(None).cast("string"))
    return out


def latest_documents(spark: SparkSession, path: str, order: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Read side of SNK3: the latest row per document - per index and ``doc_id`` where documents have an index - plus
    every document written without an id."""
    df = spark.read.parquet(path)
    key = [c for c in ("index_name", "doc_id") if c in df.columns]
    keyed = latest_by_key(df.where(F.col("doc_id").isNotNull()), key, list(order))
    return keyed.unionByName(df.where(F.col("doc_id").isNull()))


def compact(spark: SparkSession, path: str, out_path: str, order: tuple[str, ...] = ("batch_id",),
            partition_by: str | None = None) -> None:
    """Rewrite a document folder to its latest view (a new folder; swap it in when done)."""
    w = latest_documents(spark, path, order).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(out_path)


def write_topics(routed: DataFrame, path: str, mode: str = "append") -> None:
    """SNK7 (file form): one folder per topic of (value) JSON lines."""
    routed.select("topic", "value").write.mode(mode).partitionBy("topic").text(path)


def topic_messages(routed: DataFrame) -> DataFrame:
    """What a topic sink takes: topic, value, and the changed row's id as key where the routing knows it, so that all
    versions of a row go to one partition, in order."""
    key = [F.col("row_id").cast("string").alias("key")] if "row_id" in routed.columns else []
    return routed.select("topic", *key, F.col("value").cast("string").alias("value"))


def write_kafka(routed: DataFrame, bootstrap: str) -> None:
    """SNK7 (Kafka form): the ``topic`` column picks each row's topic."""
    (topic_messages(routed)
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save())


def archive_lines(logs: DataFrame, extra: str | None = None) -> DataFrame:
    """SNK8 payload: (dt, value) — the log's UTC day and the log as one JSON line (null fields left out), with the
    entries of the map column ``extra``."""
    from shoplens.functions.columns import log_date
    from shoplens.operators.routing import with_extra
    fields = [c for c in logs.columns if c != extra]
    return logs.select(log_date("ts").alias("dt"), with_extra(record_json(*fields), extra).alias("value"))


def archive_logs(logs: DataFrame, path: str, mode: str = "append") -> None:
    """SNK8: each stamped log as one JSON line, partitioned by its day."""
    _by_day(archive_lines(logs), "dt").write.mode(mode).partitionBy("dt").text(path)


def batch_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, object]:
    """SNK10: a per-batch row count observed while the data flows (no second pass); returns the observed frame
    and its Observation (read ``.get`` after an action)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("count")), obs
