"""The pipeline's jobs as runnable streaming applications.

Each app reads its topic(s) — Kafka in service, or a folder standing in for a topic (JSON lines, or with ``messages:``
Parquet files of messages with their time and offset) — runs the shared operators and writes its table.  Its checkpoint
is ``<out>.checkpoint`` unless given, so a restart goes on where it stopped.  An app started from the command line reads
each topic once, into ``<out>.intake``; its outputs stream from there: the main one, malformed records in
``<out>.rejected`` and, for jobs with event-time state, rows that came too late in ``<out>.late``.
The session is the one spark-submit configures; the app sets nothing but the time zone.

=================  ==========================  =============================================  ======================
app                input topic(s)              output                                         operators
=================  ==========================  =============================================  ======================
``dau``            start logs                  DAU table, partitioned by ``logdate``           DAU2 (FLT4, AGG1, SNK1)
``gmv``            orders                      order table, partitioned by ``CREATE_DATE``     PRJ2-4, SNK2
``alert``          event logs                  alert documents, one folder per dated index    WIN2 (SNK4)
``sale_detail``    orders + order lines        sale details, partitioned by ``dt``             JOI4 (+ JOI7)
``order_pairs``    orders + order lines        pairs and rows without one, by match state      JOI1
``user_info``      user changes                user table in hash buckets (or all versions)   SNK6 / DIM1
``route_changes``  change events               one folder (or Kafka topic) per target topic   SRC4, FLT2, PRJ7
``route_logs``     raw logs                    one folder (or Kafka topic) per log topic       FLT1, PRJ6, SNK7
``archive_logs``   raw logs                    one JSON line a log, partitioned by ``dt``      SNK8
=================  ==========================  =============================================  ======================

    python -m shoplens.streaming.apps dau --source /data/topics/start --out /data/tables/dau [--once]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoplens import schemas
from shoplens.operators import alerts
from shoplens.sinks import archive_lines
from shoplens.sources.ingest import file_stream, message_stream, topic_pattern_stream, topic_stream
from shoplens.streaming import intake, jobs


def source(spark: SparkSession, spec: str | DataFrame, max_files_per_trigger: int | None = None) -> DataFrame:
    """``kafka://<bootstrap>/<topic>`` (a topic ending in ``*`` is a pattern), ``messages:<folder>`` of Parquet messages,
    a folder of JSON-lines files, or the records of an intake."""
    if isinstance(spec, DataFrame):
        return spec
    if spec.startswith("kafka://"):
        bootstrap, topic = spec[len("kafka://"):].split("/", 1)
        if topic.endswith("*"):
            return topic_pattern_stream(spark, bootstrap, topic)
        return topic_stream(spark, bootstrap, topic)
    if spec.startswith("messages:"):
        return message_stream(spark, spec[len("messages:"):], max_files_per_trigger)
    return file_stream(spark, spec, max_files_per_trigger)


def dau_app(spark, src: str, out: str, trigger: str = jobs.BATCH_INTERVAL,
            checkpoint: str | None = None, form: str = "table") -> StreamingQuery:
    """``state``: dedup state in the query (``dau_first_seen``); ``table``: the DAU table is the seen set, one
    anti join per micro-batch after a partial aggregate (``start_dau_table_sink``; for feeds with hot devices)."""
    if form == "table":
        return jobs.start_dau_table_sink(source(spark, src), out, "dau_app", trigger=trigger, checkpoint=checkpoint)
    return jobs.start_file_sink(jobs.dau_first_seen(source(spark, src)), out, "dau_app", partition_by="logdate",
                                trigger=trigger, checkpoint=checkpoint)


def gmv_app(spark, src: str, out: str, trigger: str = jobs.BATCH_INTERVAL,
            checkpoint: str | None = None) -> StreamingQuery:
    return jobs.start_order_table_sink(source(spark, src), out, "gmv_app", trigger=trigger, checkpoint=checkpoint)


def alert_app(spark, src: str, out: str, trigger: str = jobs.BATCH_INTERVAL,
              checkpoint: str | None = None, panes: bool = False, event_lists: bool = False) -> StreamingQuery:
    """``event_lists``: documents hold every event id as a list, as often as it occurred, in place of their counts."""
    docs = jobs.alert_stream(source(spark, src), panes=panes)
    if event_lists:
        docs = docs.withColumn("events", alerts.event_list())
    return jobs.start_document_sink(docs, out, "alert_app", partition_by="index_name", trigger=trigger, checkpoint=checkpoint)


def sale_detail_app(spark, orders_src: str, details_src: str, out: str, users_table: str | None = None,
                    trigger: str = jobs.BATCH_INTERVAL, checkpoint: str | None = None,
                    salt_buckets: int = jobs.SALT_BUCKETS) -> StreamingQuery:
    """With ``users_table``, each micro-batch is joined to the users as they stand then."""
    df = jobs.sale_detail_stream(source(spark, orders_src), source(spark, details_src), salt_buckets=salt_buckets)
    if users_table:
        return jobs.start_enriched_sink(df, users_table, out, "sale_detail_app", trigger=trigger, checkpoint=checkpoint)
    return jobs.start_file_sink(df, out, "sale_detail_app", partition_by="dt", trigger=trigger, checkpoint=checkpoint)


def order_pairs_app(spark, orders_src: str, details_src: str, out: str, trigger: str = jobs.BATCH_INTERVAL,
                    checkpoint: str | None = None) -> StreamingQuery:
    """JOI1 live: what met within the join's time, and what met nothing once its time is over."""
    pairs = jobs.order_pairs_stream(source(spark, orders_src), source(spark, details_src))
    return jobs.start_file_sink(pairs, out, "order_pairs_app", partition_by="match_state", trigger=trigger, checkpoint=checkpoint)


def user_info_app(spark, src: str, out: str, trigger: str = jobs.BATCH_INTERVAL,
                  checkpoint: str | None = None, form: str = "table") -> StreamingQuery:
    """``table``: the latest version of each user, in hash buckets; ``log``: every version."""
    if form == "table":
        return jobs.start_user_table_sink(source(spark, src), out, "user_info_app", trigger=trigger, checkpoint=checkpoint)
    return jobs.start_file_sink(jobs.user_changes(source(spark, src)), out, "user_info_app", trigger=trigger,
                                checkpoint=checkpoint)


def _start_topics(routed: DataFrame, out: str, name: str, trigger: str, checkpoint: str | None) -> StreamingQuery:
    """Routed messages to Kafka (``kafka://<bootstrap>``), or to a folder per topic: Parquet with the message's time and
    offset where it has them, else text lines."""
    if out.startswith("kafka://"):
        if not checkpoint:
            raise ValueError("a Kafka output needs a checkpoint folder")
        return jobs.start_topic_sink(routed, out[len("kafka://"):], name, checkpoint, trigger)
    carried = [c for c in jobs.ARRIVAL if c in routed.columns]
    return jobs.start_file_sink(routed.select("topic", "value", *carried), out, name, fmt="parquet" if carried else "text",
                                partition_by="topic", trigger=trigger, checkpoint=checkpoint)


def route_changes_app(spark, src: str, out: str, database: str, trigger: str = jobs.BATCH_INTERVAL,
                      checkpoint: str | None = None) -> StreamingQuery:
    return _start_topics(jobs.routed_changes(source(spark, src), database), out, "route_changes_app", trigger, checkpoint)


def route_logs_app(spark, src: str, out: str, trigger: str = jobs.BATCH_INTERVAL,
                   checkpoint: str | None = None) -> StreamingQuery:
    routed = jobs.routed_logs(source(spark, src), stamp=True).select("topic", "value")
    return _start_topics(routed, out, "route_logs_app", trigger, checkpoint)


def archive_logs_app(spark, src: str, out: str, trigger: str = jobs.BATCH_INTERVAL,
                     checkpoint: str | None = None) -> StreamingQuery:
    logs = jobs.parsed(source(spark, src), schemas.RAW_LOG, extra="_more")
    return jobs.start_file_sink(archive_lines(logs, extra="_more"), out, "archive_logs_app", fmt="text", partition_by="dt",
                                trigger=trigger, checkpoint=checkpoint)


SOURCE_SCHEMA = {app: schemas.STREAMS[stream][1] for app, stream in
                 (("dau", "startup"), ("gmv", "order_info"), ("alert", "event"), ("sale_detail", "order_info"), ("order_pairs", "order_info"), ("user_info", "user_info"))}
SOURCE_SCHEMA |= {"route_changes": schemas.CHANGE_EVENT, "route_logs": schemas.RAW_LOG, "archive_logs": schemas.RAW_LOG}

PAIRED = ("sale_detail", "order_pairs")  # apps with a second topic, of order lines

APPS = ("dau", "gmv", "alert", *PAIRED, "user_info", "route_changes", "route_logs", "archive_logs")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="shoplens.streaming.apps")
    p.add_argument("app", choices=APPS)
    p.add_argument("--source", required=True, help="kafka://host:port/topic or a folder of JSON lines")
    p.add_argument("--source2", help="order-line source for sale_detail and order_pairs")
    p.add_argument("--users", help="user change table for sale_detail enrichment")
    p.add_argument("--out", required=True)
    p.add_argument("--database", default="shop")
    p.add_argument("--checkpoint", help="default: <out>.checkpoint")
    p.add_argument("--once", action="store_true", help="process what is there and stop (availableNow)")
    p.add_argument("--dau-form", choices=["state", "table"], default="table",
                   help="dau: the stored table as the seen set (safe for hot devices), or dedup state in the query")
    p.add_argument("--user-form", choices=["table", "log"], default="table",
                   help="user_info: the latest version of each user in hash buckets, or every version")
    p.add_argument("--salt-buckets", type=int, default=jobs.SALT_BUCKETS, help="sale_detail: join slots of one order id")
    p.add_argument("--panes", action="store_true", help="alert: fold 5 s panes before the windows (dense feeds)")
    p.add_argument("--event-lists", action="store_true", help="alert: every event id as a list in place of the counts")
    a = p.parse_args(argv)
    if a.app in PAIRED and not a.source2:
        p.error(f"{a.app} needs --source2")

    from shoplens.session import submitted_session
    spark = submitted_session(f"shoplens-{a.app}")
    trigger = "availableNow" if a.once else jobs.BATCH_INTERVAL
    queries = start(spark, a, trigger)
    for q in queries:
        q.awaitTermination()


def side_path(out: str, checkpoint: str | None) -> str:
    """What the names of side outputs start with: the output, or the checkpoint of an output that is no folder."""
    return (checkpoint if out.startswith("kafka://") else out).rstrip("/")


def lateness_of(a: argparse.Namespace) -> dict[str, intake.Lateness]:
    """Per input of the app ("" or ".lines"), what makes a row late; jobs without event-time state have none."""
    if a.app == "alert":
        return {"": intake.alert_lateness(panes=a.panes)}
    if a.app == "dau" and a.dau_form == "state":
        return {"": intake.log_lateness()}
    if a.app in PAIRED:
        return {"": intake.text_lateness("create_time"), ".lines": intake.text_lateness("detail_time")}
    return {}


def taken_in(spark: SparkSession, a: argparse.Namespace, src: str, tag: str, schema, trigger: str) -> tuple[DataFrame, list[StreamingQuery]]:
    """The good records of one topic, and the queries that read it and keep its other records."""
    base, late = side_path(a.out, a.checkpoint) + tag, lateness_of(a).get(tag)
    messages = source(spark, src)
    carried = tuple(c for c in intake.CARRIED if c in messages.columns)
    if late and tag and "timestamp" in carried:
        late = intake.text_lateness("detail_time", arrival="timestamp")
    extra = "_more" if schema is schemas.RAW_LOG else None
    path, name = f"{base}.intake", f"{a.app}{tag.replace('.', '_')}"
    queries = [intake.start_intake(messages, schema, path, f"{name}_intake", late, extra, trigger)]
    if trigger == "availableNow":
        queries[0].awaitTermination()  # what is behind it ends with what is there now
    for kind in (intake.REJECTED, *((intake.LATE,) if late else ())):
        rows = intake.records(spark, path, schema, kind, carried, extra)
        queries.append(jobs.start_file_sink(rows, f"{base}.{kind}", f"{name}_{kind}", trigger=trigger))
    return intake.records(spark, path, schema, intake.GOOD, carried, extra), queries


def start(spark: SparkSession, a: argparse.Namespace, trigger: str) -> list[StreamingQuery]:
    """The app's query, and those that take its topics in and keep their malformed and late records."""
    src, queries = taken_in(spark, a, a.source, "", SOURCE_SCHEMA[a.app], trigger)
    if a.app in PAIRED:
        lines, more = taken_in(spark, a, a.source2, ".lines", schemas.ORDER_DETAIL, trigger)
        queries += more
        if a.app == "order_pairs":
            q = order_pairs_app(spark, src, lines, a.out, trigger, a.checkpoint)
        else:
            q = sale_detail_app(spark, src, lines, a.out, a.users, trigger, a.checkpoint, a.salt_buckets)
    elif a.app == "dau":
        q = dau_app(spark, src, a.out, trigger, a.checkpoint, form=a.dau_form)
    elif a.app == "route_changes":
        q = route_changes_app(spark, src, a.out, a.database, trigger, a.checkpoint)
    elif a.app == "alert":
        q = alert_app(spark, src, a.out, trigger, a.checkpoint, a.panes, a.event_lists)
    elif a.app == "user_info":
        q = user_info_app(spark, src, a.out, trigger, a.checkpoint, a.user_form)
    else:
        q = {"gmv": gmv_app, "route_logs": route_logs_app,
             "archive_logs": archive_logs_app}[a.app](spark, src, a.out, trigger, a.checkpoint)
    return [q, *queries]


if __name__ == "__main__":
    main()
