"""Routing of raw logs (FLT1) and of change events (FLT2) to topics.

Routing is a column: one DataFrame with ``topic`` and ``value`` goes to one sink, whose ``topic`` column picks the
destination (Kafka sink) or the folder (file sink ``partitionBy('topic')``).  No per-row Python, no per-topic scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import after_image_json, last_entries, record_json
from shoplens.schemas import TOPIC_EVENT, TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO, TOPIC_START, TOPIC_USER_INFO


def log_topic() -> F.Column:
    """FLT1: ``startup`` → start topic; anything else, null included → event topic."""
    return F.when(F.col("type") == "startup", F.lit(TOPIC_START)).otherwise(F.lit(TOPIC_EVENT))


def route_logs(logs: DataFrame, stamp: F.Column | None = None, extra: str | None = None) -> DataFrame:
    """FLT1 + PRJ6 + SNK7 payload: stamp ``ts`` with the receive time (when given), add the topic, serialise.
    ``extra`` names a map column of further fields, which are kept in the payload."""
    if stamp is not None:
        logs = logs.withColumn("ts", stamp)
    fields = [c for c in logs.columns if c != extra]
    return logs.select(log_topic().alias("topic"), *fields, with_extra(record_json(*fields), extra).alias("value"))


def with_extra(json: F.Column, extra: str | None) -> F.Column:
    """A JSON object with the entries of the map column ``extra`` added."""
    if extra is None:
        return json
    more = F.to_json(F.col(extra))
    sep = F.when(json == "{}", F.lit("")).otherwise(F.lit(","))
    joined = F.concat(F.substring(json, 1, F.length(json) - 1), sep, F.substring(more, 2, F.length(more)))
    return F.when(F.coalesce(F.size(extra), F.lit(0)) > 0, joined).otherwise(json)


def change_topic() -> F.Column:
    """FLT2: order_info INSERT → order topic; order_detail INSERT → detail topic; user_info INSERT or UPDATE →
    user topic; anything else → null (dropped)."""
    t, e = F.col("table_name"), F.col("event_type")
    return (F.when((t == "order_info") & (e == "INSERT"), F.lit(TOPIC_ORDER_INFO))
            .when((t == "order_detail") & (e == "INSERT"), F.lit(TOPIC_ORDER_DETAIL))
            .when((t == "user_info") & e.isin("INSERT", "UPDATE"), F.lit(TOPIC_USER_INFO)))


def route_changes(changes: DataFrame, database: str) -> DataFrame:
    """SRC4 + FLT2 + PRJ7: keep row-data entries of ``database``, route them, and fold each after-image into one
    JSON object (all values text).  A ``timestamp`` and ``offset`` of the change (its commit time and place in the
    change log) are carried to the routed message: consumers take arrival time and order from there."""
    rows = changes.where((F.col("entry_type") == "ROWDATA")
                         & F.col("db_table").startswith(F.lit(database + ".")))
    carried = [c for c in ("timestamp", "partition", "offset") if c in changes.columns]
    routed = rows.select(change_topic().alias("topic"), "table_name", "event_type", "after", *carried)
    return (routed.where(F.col("topic").isNotNull())
            .select("topic", "table_name", "event_type",
                    F.map_from_entries(last_entries("after"))["id"].alias("row_id"),
                    after_image_json("after").alias("value"), *carried))
