"""The operators wired as Structured Streaming queries (STR1-8).

Each job is: a source of JSON messages (Kafka topic or a folder standing in for one) → ``parse_records`` → the same
operator functions the batch queries use → a sink with its own checkpoint.  Event time is the record's ``ts``
(epoch ms) or its text time; every stateful step has a watermark, so state stays bounded:

- DAU: (device, day) keys for the watermark delay (one day by default).
- Order/detail join: rows within ``ttl`` + the watermark delay on each side.
- Alert: the panes of each device that are still in an open window (window length + delay).

Triggers: ``processingTime='5 seconds'`` (the 5 s batch interval) in service, ``availableNow`` in tests and
back-fills.  Sinks are exactly-once file sinks or idempotent keyed appends, so a restarted query resumes from its
checkpoint without loss or visible duplicates.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shoplens.functions.columns import event_time, money
from shoplens.operators import alerts, dau, gmv, routing, sales
from shoplens.schemas import CHANGE_EVENT, EVENT_LOG, ORDER_DETAIL, ORDER_INFO, RAW_LOG, STARTUP_LOG, USER_INFO
from shoplens.session import checkpoint_path, ship_code
from shoplens.sinks import keyed_table, runs, topic_messages, upsert_documents
from shoplens.sources.ingest import CORRUPT, good_records, parse_records

BATCH_INTERVAL = "5 seconds"


ARRIVAL = ("timestamp", "partition", "offset")  # what a topic's messages carry besides their value


def _keep(messages: DataFrame, *wanted: str) -> tuple[str, ...]:
    return tuple(c for c in wanted if c in messages.columns)


def parsed(messages: DataFrame, schema, *keep: str, extra: str | None = None) -> DataFrame:
    """The good records; an intake (``streaming.intake``) keeps the others, and its rows are parsed already."""
    if "value" not in messages.columns:
        return messages.select(*schema.names, *_keep(messages, *keep), *((extra,) if extra else ()))
    return good_records(parse_records(messages, schema, _keep(messages, *keep), extra))


def order_lines(messages: DataFrame) -> DataFrame:
    """Order lines with ``detail_time``: their own, or else the arrival time of their message."""
    lines = parsed(messages, ORDER_DETAIL, "timestamp")
    if "timestamp" not in lines.columns:
        return lines
    arrival = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    return lines.withColumn("detail_time", F.coalesce("detail_time", arrival)).drop("timestamp")


# ---- DAU (DAU2) ---------------------------------------------------------------------------------------------------

def dau_first_seen(startup_msgs: DataFrame, delay: str = "1 day") -> DataFrame:
    """DAU2, immediate form: the first log of each (device, day) to arrive, emitted in the batch it arrives in.
    State: (mid, logdate) keys, dropped once the watermark passes them; ``delay`` is a day at least, as a key dropped
    within its day would count the device again."""
    if pd.Timedelta(delay) < pd.Timedelta(days=1):
        raise ValueError("delay must be a day or more: devices are counted once a day")
    logs = dau.with_log_time(parsed(startup_msgs, STARTUP_LOG)).withColumn("event_time", event_time("ts"))
    return (logs.withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["mid", "logdate"])
            .drop("event_time"))


def dau_earliest(startup_msgs: DataFrame, delay: str = "1 day") -> DataFrame:
    """DAU2, exact form: the earliest log of each (device, day), emitted when the day closes (append mode)."""
    logs = dau.with_log_time(parsed(startup_msgs, STARTUP_LOG)).withColumn("event_time", event_time("ts"))
    rest = [c for c in logs.columns if c not in ("mid", "logdate", "ts", "event_time")]
    return (logs.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", "1 day"), "mid", "logdate")
            .agg(F.min(F.struct("ts", *rest)).alias("_first"))
            .select("mid", "logdate", "_first.*"))


SEEN_BUCKETS = 4  # of a day's devices
FIRST = StructType([StructField("mid", StringType()), StructField("first_day", StringType()), StructField("earlier", LongType())])


NO_DAY = "none"


def month_of(day) -> Column:
    """The group of a day's roll-up rows: its month, or that of rows without a day."""
    return F.coalesce(F.substring(day, 1, 7), F.lit(NO_DAY))


def store_dau_batch(logs: DataFrame, path: str, batch_id: int, buckets: int = SEEN_BUCKETS) -> None:
    """DAU2 for one micro-batch, in the reference's order (FLT4 → AGG1 → SNK5 + SNK1), and what the dashboard reads.

    Beside the table ``path`` stand ``.seen`` (the device-days stored so far, in merged runs by day and bucket: only those
    the batch falls in are opened), ``.first`` (each device's first day, in hash buckets), ``.hours`` (devices by day and
    hour) and ``.new`` (new devices by day), the last two as roll-ups.  A late log that moves a device's first day back
    takes it out of the day that had it.  All are stored under the batch's id and read as they were before it, so a
    replayed batch writes the same rows again.
    """
    from shoplens.sinks import write_dau_batch

    spark, path = logs.sparkSession, path.rstrip("/")
    day = F.coalesce("logdate", F.lit(NO_DAY))
    group = F.concat_ws("_", day, F.pmod(F.xxhash64("mid"), F.lit(buckets)).cast("string"))
    logs = logs.withColumn("grp", group).persist()
    fresh = None
    try:
        groups = [r["grp"] for r in logs.select("grp").distinct().collect()]  # days of the batch times buckets
        if not keyed_table.exists(spark, f"{path}.seen"):  # a table that was written before there was a seen set
            _seed_seen(spark, path, batch_id, buckets)
        seen = runs.read_runs(spark, f"{path}.seen", "mid string", groups, before=batch_id).select(F.col("mid").alias("s_mid"), F.col("grp").alias("s_grp"))
        unseen = logs.join(seen, F.col("mid").eqNullSafe(F.col("s_mid")) & (F.col("grp") == F.col("s_grp")), "left_anti")
        fresh = dau.daily_active(unseen.drop("grp")).persist()
        write_dau_batch(fresh, path, batch_id)

        days = fresh.select("mid", F.col("logdate").alias("first_day")).where("first_day IS NOT NULL AND mid IS NOT NULL")
        days = days.groupBy("mid").agg(F.max(-F.unix_date(F.to_date("first_day"))).cast("long").alias("earlier"))
        days = days.withColumn("first_day", F.date_format(F.date_from_unix_date((-F.col("earlier")).cast("int")), "yyyy-MM-dd")).select(*FIRST.names)
        known = keyed_table.lookup(days, f"{path}.first", FIRST, ("mid",), ("earlier",), before=batch_id)
        known = known.select(F.col("mid").alias("k_mid"), F.col("first_day").alias("k_day"), F.col("earlier").alias("k_earlier"))
        moved = days.join(known, F.col("mid") == F.col("k_mid"), "left").where("k_mid IS NULL OR earlier > k_earlier")
        change = F.when(F.col("k_mid").isNull(), F.array(F.struct(F.col("first_day").alias("logdate"), F.lit(1).cast("long").alias("n"))))
        change = change.otherwise(F.array(F.struct(F.col("first_day").alias("logdate"), F.lit(1).cast("long").alias("n")), F.struct(F.col("k_day").alias("logdate"), F.lit(-1).cast("long").alias("n"))))
        firsts = moved.select(F.inline(change)).select(month_of("logdate").alias("grp"), "logdate", "n")
        hours = fresh.select(month_of("logdate").alias("grp"), "logdate", "loghour", F.lit(1).cast("long").alias("n"))
        runs.append_run(firsts, f"{path}.new", batch_id, runs.summed("logdate"))
        runs.append_run(hours, f"{path}.hours", batch_id, runs.summed("logdate", "loghour"))
        keyed_table.write_keyed(moved.select(*FIRST.names), f"{path}.first", batch_id, ("mid",), ("earlier",))
        runs.append_run(fresh.select(group.alias("grp"), "mid"), f"{path}.seen", batch_id, runs.distinct)
    finally:
        logs.unpersist()
        if fresh is not None:
            fresh.unpersist()


def _seed_seen(spark: SparkSession, path: str, batch_id: int, buckets: int) -> None:
    """The seen set, roll-ups and first days of a DAU table that has none, from its rows before ``batch_id``."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return
    if "batch_id" not in stored.columns:
        raise ValueError(f"{path} was written by another form of the DAU job; give each form a table of its own")
    stored = stored.where(F.col("batch_id") < batch_id).withColumn("logdate", F.col("logdate").cast("string"))
    group = F.concat_ws("_", F.coalesce("logdate", F.lit(NO_DAY)), F.pmod(F.xxhash64("mid"), F.lit(buckets)).cast("string"))
    days = stored.where("logdate IS NOT NULL AND mid IS NOT NULL").groupBy("mid").agg(F.max(-F.unix_date(F.to_date("logdate"))).cast("long").alias("earlier"))
    days = days.withColumn("first_day", F.date_format(F.date_from_unix_date((-F.col("earlier")).cast("int")), "yyyy-MM-dd")).select(*FIRST.names)
    before = batch_id - 1
    runs.append_run(days.select(month_of("first_day").alias("grp"), F.col("first_day").alias("logdate"), F.lit(1).cast("long").alias("n")), f"{path}.new", before, runs.summed("logdate"))
    runs.append_run(stored.select(month_of("logdate").alias("grp"), "logdate", "loghour", F.lit(1).cast("long").alias("n")), f"{path}.hours", before, runs.summed("logdate", "loghour"))
    keyed_table.write_keyed(days, f"{path}.first", before, ("mid",), ("earlier",))
    runs.append_run(stored.select(group.alias("grp"), "mid"), f"{path}.seen", before, runs.distinct)


def start_dau_table_sink(startup_msgs: DataFrame, path: str, name: str, trigger: str = BATCH_INTERVAL,
                         checkpoint: str | None = None) -> StreamingQuery:
    """DAU2 per micro-batch (``store_dau_batch``), skew-safe: a device with a third of all logs ships one row per task, and no
    state grows in the query.  ``dau_first_seen`` is the stateful form (its dedup shuffles raw rows, no map-side combine)."""
    checkpoint = own_checkpoint(startup_msgs.sparkSession, path, checkpoint)
    logs = dau.with_log_time(parsed(startup_msgs, STARTUP_LOG))
    w = (logs.writeStream.outputMode("append").queryName(name).foreachBatch(lambda batch, batch_id: store_dau_batch(batch, path, batch_id))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


# ---- order / detail join (JOI4 + JOI7) ----------------------------------------------------------------------------

SALT_BUCKETS = 8  # join slots of one order id, unless asked otherwise: streams get no skew split


def sale_detail_stream(order_msgs: DataFrame, detail_msgs: DataFrame, ttl_seconds: int = sales.DEFAULT_TTL_SECONDS,
                       delay: str = "2 minutes", users_latest: DataFrame | None = None,
                       as_of: str | None = None, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """JOI4 as a stream-stream inner join with event-time bounds; optional JOI7 against a static user table.

    Both sides are projected before the join, so join state holds only the sale-detail fields.

    ``salt_buckets`` > 1 spreads one order id over that many join partitions: each detail goes to the bucket
    ``pmod(hash(detail id), k)`` and each order row is copied into all k buckets, so every (order, detail) pair
    still meets exactly once.  Streams get no AQE skew split, so this is the guard for a hot order id (an order
    with a large share of all detail lines); it costs k copies of the order side's state (one row per order).
    """
    o = (sales.order_side(gmv.clean_orders(parsed(order_msgs, ORDER_INFO)))
         .withWatermark("order_ts", delay))
    d = sales.detail_side(order_lines(detail_msgs)).withWatermark("detail_ts", delay)
    cond = (F.col("order_id") == F.col("d_order_id")) & sales.within_ttl(ttl_seconds)
    if salt_buckets > 1:
        o = o.withColumn("o_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        d = d.withColumn("d_salt", F.pmod(F.hash("order_detail_id"), F.lit(salt_buckets)))
        cond = cond & (F.col("o_salt") == F.col("d_salt"))
    out = o.join(d, cond, "inner").select(*sales.SALE_COLUMNS)
    if users_latest is not None:
        out = sales.with_user(out, users_latest, as_of or F.current_date())
    return out


def order_pairs_stream(order_msgs: DataFrame, detail_msgs: DataFrame, ttl_seconds: int = sales.DEFAULT_TTL_SECONDS,
                       delay: str = "2 minutes") -> DataFrame:
    """JOI1 as a stream: orders and details that meet within ``ttl_seconds`` (``both``), and each row that met none once
    the watermark has passed its time (``order_only``, ``detail_only``)."""
    o = sales.order_side(gmv.clean_orders(parsed(order_msgs, ORDER_INFO))).select("order_id", "order_ts").withWatermark("order_ts", delay)
    d = sales.detail_side(order_lines(detail_msgs)).select("order_detail_id", "d_order_id", "detail_ts").withWatermark("detail_ts", delay)
    pairs = o.join(d, (F.col("order_id") == F.col("d_order_id")) & sales.within_ttl(ttl_seconds), "fullOuter")
    state = (F.when(F.col("order_detail_id").isNull(), F.lit("order_only")).when(F.col("order_id").isNull(), F.lit("detail_only"))
             .otherwise(F.lit("both")))
    return pairs.select(F.coalesce("order_id", "d_order_id").alias("order_id"), "order_detail_id", state.alias("match_state"))


# ---- coupon alert (WIN2) ------------------------------------------------------------------------------------------

def alert_stream(event_msgs: DataFrame, delay: str = "10 seconds",
                 window_seconds: int = alerts.DEFAULT_WINDOW_SECONDS,
                 slide_seconds: int = alerts.DEFAULT_SLIDE_SECONDS,
                 min_uids: int = alerts.DEFAULT_MIN_UIDS, panes: bool = False, ring: bool = True) -> DataFrame:
    """WIN1 → AGG6 → FLT5 → PRJ10 in append mode: each window is judged once, when the watermark closes it.
    Several windows of one device-minute share a ``doc_id``; the keyed sink keeps the last.

    The default keeps each device's panes as state (``alert_ring``); it needs the window to be a multiple of the slide.
    With ``ring=False`` windows are stateful aggregates over copied events; ``panes`` runs them as two chained
    aggregations (5 s panes, then windows over closed panes)."""
    ev = parsed(event_msgs, EVENT_LOG).select("mid", "uid", "evid", "itemid", "ts",
                                               event_time("ts").alias("event_time"))
    if ring and not panes and window_seconds % slide_seconds == 0:
        return alerts.as_documents(alert_ring(ev, delay, window_seconds, slide_seconds, min_uids))
    fold = alerts.pane_fold if panes else alerts.window_fold
    folded = fold(ev.withWatermark("event_time", delay), window_seconds, slide_seconds)
    return alerts.as_documents(alerts.firing(folded, min_uids))


RING_OUT = "mid string, window_start long, ts long, uids array<string>, item_ids array<string>, n_events long, events string"
RING_STATE = "panes string, judged long"


def alert_ring(events: DataFrame, delay: str, window_seconds: int, slide_seconds: int, min_uids: int) -> DataFrame:
    """WIN2 live over keyed state with timers: per device its panes that are still in an open window - a ring of a window's
    panes, and those ahead of the watermark.  An event is added to its pane alone.  When the watermark passes the end of
    windows, those not judged yet are judged in one walk over the panes, and panes that have left the last of them go.

    Yields, as the batch form does, a minute's last firing window; where a minute's windows close in several
    micro-batches, its later alert replaces the earlier in the keyed sink.
    """
    ship_code(events.sparkSession)
    k, slide = window_seconds // slide_seconds, slide_seconds * 1000
    span = window_seconds * 1000
    # An event matters as long as one of its windows is open, a window's length behind the watermark of the ends.  Rows
    # are dropped by the query's own watermark, so that one lies a window's length further back.
    lag = f"{int(pd.Timedelta(delay).total_seconds() * 1000) + span} milliseconds"

    def run(key, batches, state):
        panes, judged = {}, None
        if state.exists:
            text, judged = state.get
            panes = {int(p): [set(u), set(i), Counter({None if e == "" else e[1:]: n for e, n in ids.items()})] for p, (u, i, ids) in json.loads(text).items()}
        for batch in batches:
            for uid, evid, item, ts in zip(batch.uid, batch.evid, batch.itemid, batch.ts):
                pane = panes.setdefault(int(ts) // slide, [set(), set(), Counter()])
                pane[2][evid] += 1
                if evid == alerts.COUPON:
                    pane[0].update(x for x in (uid,) if x is not None)
                    pane[1].update(x for x in (item,) if x is not None)
        closed = (state.getCurrentWatermarkMs() + span) // slide - 1  # the last pane that a closed window ends with
        first = min(panes, default=closed + 1) if judged is None or judged < 0 else judged + 1
        for p in [p for p in panes if p + k - 1 < first and judged is not None and judged >= 0]:
            del panes[p]  # late: all its windows are closed
        found = []
        if panes and first <= closed:
            last = min(closed, max(panes) + k - 1)
            found = alerts.judge_ring(panes, max(first, min(panes)), last, k, slide, min_uids)
        judged = max(closed, -1 if judged is None else judged)
        panes = {p: v for p, v in panes.items() if p + k - 1 > judged}
        if panes:
            held = {p: [sorted(u), sorted(i), {"" if e is None else "=" + e: n for e, n in ids.items()}] for p, (u, i, ids) in panes.items()}
            state.update((json.dumps(held), judged))
            # the end of the next window that holds anything, by the query's own watermark
            state.setTimeoutTimestamp((max(judged + 1, min(panes)) + 1) * slide - span)
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame([(key[0], (e + 1) * slide - span, (e + 1) * slide, u, i, n, text) for e, u, i, text, n in found],
                               columns=["mid", "window_start", "ts", "uids", "item_ids", "n_events", "events"])

    timed = events.where(F.col("event_time").isNotNull()).withWatermark("event_time", lag)
    return timed.groupBy("mid").applyInPandasWithState(run, RING_OUT, RING_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# ---- orders (GMV job: PRJ2-4 + SNK2) ------------------------------------------------------------------------------


def store_order_amounts(orders_clean: DataFrame, path: str, batch_id: int) -> None:
    """AGG4, AGG5 for one micro-batch: the orders' amounts by day and hour, as a roll-up beside the order table."""
    rows = orders_clean.select(month_of("create_date").alias("grp"), "create_date", "create_hour", money("total_amount").cast("decimal(38,2)").alias("amount"),
                               F.lit(1).cast("long").alias("n"))
    runs.append_run(rows, f"{path.rstrip('/')}.amounts", batch_id, runs.summed("create_date", "create_hour"))


def start_order_table_sink(order_msgs: DataFrame, path: str, name: str, trigger: str = BATCH_INTERVAL,
                           checkpoint: str | None = None, mask: str = "prefix4") -> StreamingQuery:
    """SNK2 live: each micro-batch's cleaned orders, under their day and the batch's id, and their amounts as a roll-up."""
    checkpoint = own_checkpoint(order_msgs.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            table = gmv.table_columns(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
            (table.hint("rebalance", "CREATE_DATE").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("CREATE_DATE", "batch_id").parquet(path))
            store_order_amounts(batch, path, batch_id)
        finally:
            batch.unpersist()

    orders = gmv.clean_orders(parsed(order_msgs, ORDER_INFO), mask)
    w = orders.writeStream.outputMode("append").queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def orders_table_stream(order_msgs: DataFrame, mask: str = "prefix4") -> DataFrame:
    """Cleaned orders with the order table's upper-case column names; write with ``partition_by='CREATE_DATE'``."""
    return gmv.table_columns(gmv.clean_orders(parsed(order_msgs, ORDER_INFO), mask))


# ---- user dimension (DIM1) and routing ----------------------------------------------------------------------------

def user_changes(user_msgs: DataFrame) -> DataFrame:
    """SNK6 input: user versions as they arrive, with their messages' ``timestamp``, ``partition`` and ``offset`` where the
    source has them; ``latest_users`` is the read side."""
    users = parsed(user_msgs, USER_INFO, *ARRIVAL)
    return users.select(*USER_INFO.names, *_keep(users, *ARRIVAL))


def user_latest_stream(user_msgs: DataFrame) -> DataFrame:
    """DIM1 kept live: latest version per user id (update / complete output mode).  State: one row per user — the
    size of the dimension itself."""
    from shoplens.operators.dims import latest_users
    return latest_users(user_changes(user_msgs))


def routed_logs(raw_msgs: DataFrame, stamp: bool = False) -> DataFrame:
    """FLT1 + PRJ6: raw logs with their topic and JSON value (receive-time stamp optional)."""
    logs = parsed(raw_msgs, RAW_LOG, extra="_more")
    return routing.route_logs(logs, F.unix_millis(F.current_timestamp()) if stamp else None, extra="_more")


def routed_changes(change_msgs: DataFrame, database: str) -> DataFrame:
    """SRC4 + FLT2 + PRJ7 on a change-event stream."""
    return routing.route_changes(parsed(change_msgs, CHANGE_EVENT, *ARRIVAL), database)


# ---- sinks --------------------------------------------------------------------------------------------------------

def _trigger(writer, trigger: str):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def own_checkpoint(spark: SparkSession, path: str, checkpoint: str | None) -> str:
    """The checkpoint of the query that writes ``path``: the given one, or ``<path>.checkpoint``, so a restart with the
    same output goes on where it stopped.  An output that another checkpoint has written to is refused: its files and
    batch numbers would be taken for this query's own.  The claim is a small file beside the output."""
    checkpoint = checkpoint or path.rstrip("/") + ".checkpoint"
    owner = path.rstrip("/") + ".owner"
    try:
        claimed = [r["value"] for r in spark.read.text(owner).collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        claimed = []
    if not claimed:
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.mode("overwrite").text(owner)
    elif claimed != [checkpoint]:
        raise ValueError(f"{path} belongs to the checkpoint {claimed[0]}; use that one, or another output")
    return checkpoint


def start_split_sink(messages: DataFrame, schema, transform: Callable[[DataFrame], DataFrame], path: str, rejects: str,
                     name: str, trigger: str = BATCH_INTERVAL, checkpoint: str | None = None) -> StreamingQuery:
    """STR8: two outputs over one parsed source, for stateless jobs.  Each micro-batch is parsed once and kept while the
    good records go through ``transform`` to ``path`` and the malformed ones to ``rejects``, both under the batch's id."""
    checkpoint = own_checkpoint(messages.sparkSession, path, checkpoint)
    records = parse_records(messages, schema, _keep(messages, *ARRIVAL))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            bad = batch.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"), *_keep(batch, *ARRIVAL))
            for rows, to in ((transform(good_records(batch)), path), (bad, rejects)):
                (rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(to))
        finally:
            batch.unpersist()

    w = records.writeStream.outputMode("append").queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_enriched_sink(sales_rows: DataFrame, users_path: str, path: str, name: str, trigger: str = BATCH_INTERVAL,
                        checkpoint: str | None = None, as_of=None) -> StreamingQuery:
    """JOI7 live: each micro-batch of sale details is joined to the user table as it stands then, and stored under its
    day and batch id (a replayed batch replaces its own folders)."""
    checkpoint = own_checkpoint(sales_rows.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = sales.with_user(batch, users_of(batch, users_path), as_of or F.current_date())
            (rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch_id").parquet(path))
        finally:
            batch.unpersist()

    w = sales_rows.writeStream.outputMode("append").queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def users_of(batch: DataFrame, users_path: str) -> DataFrame:
    """The latest users that the batch's ``user_id`` name: from a bucketed table only the buckets they fall in, from a
    plain table of versions the whole of it.  Before the table is there, nobody is known."""
    from shoplens.operators.dims import latest_users, version_order

    spark = batch.sparkSession
    if keyed_table.exists(spark, users_path):
        asked = batch.select(F.col("user_id").alias("id")).where("id IS NOT NULL")
        schema = keyed_table.with_arrival(USER_INFO)
        return keyed_table.lookup(asked, users_path, schema, USER_KEYS, version_order(schema.names))
    try:
        versions = spark.read.schema(USER_INFO).parquet(users_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        versions = spark.createDataFrame([], USER_INFO)
    return latest_users(versions)


USER_KEYS = ("id",)


def start_user_table_sink(user_msgs: DataFrame, path: str, name: str, trigger: str = BATCH_INTERVAL,
                          checkpoint: str | None = None, n_buckets: int = keyed_table.N_BUCKETS) -> StreamingQuery:
    """DIM1 / SNK6 live: each micro-batch of user versions goes into the buckets its ids fall in."""
    from shoplens.operators.dims import version_order

    checkpoint = own_checkpoint(user_msgs.sparkSession, path, checkpoint)
    schema = keyed_table.with_arrival(USER_INFO)

    def write(batch: DataFrame, batch_id: int) -> None:
        have = set(batch.columns)
        rows = batch.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
        keyed_table.write_keyed(rows, path, batch_id, USER_KEYS, version_order(schema.names), n_buckets)

    w = user_changes(user_msgs).writeStream.outputMode("append").queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_topic_sink(routed: DataFrame, bootstrap: str, name: str, checkpoint: str, trigger: str = BATCH_INTERVAL) -> StreamingQuery:
    """SNK7 live: the ``topic`` column picks each message's topic."""
    w = (topic_messages(routed).writeStream.format("kafka").queryName(name)
         .options(**topic_options(bootstrap, checkpoint)))
    return _trigger(w, trigger).start()


def topic_options(bootstrap: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "checkpointLocation": checkpoint}


def start_file_sink(df: DataFrame, path: str, name: str, fmt: str = "parquet", partition_by: str | None = None,
                    trigger: str = BATCH_INTERVAL, checkpoint: str | None = None) -> StreamingQuery:
    """Exactly-once file sink (append); its checkpoint is beside the output unless given (see ``own_checkpoint``)."""
    w = (df.writeStream.format(fmt).outputMode("append").queryName(name)
         .option("checkpointLocation", own_checkpoint(df.sparkSession, path, checkpoint)))
    if partition_by:
        w = w.partitionBy(partition_by)
    return _trigger(w, trigger).start(path)


def start_document_sink(docs: DataFrame, path: str, name: str, partition_by: str | None = None,
                        trigger: str = BATCH_INTERVAL, checkpoint: str | None = None) -> StreamingQuery:
    """SNK3 for streams: each micro-batch stored under its batch id; a replayed batch (after a failure, on restart
    from the checkpoint) replaces its own folder with the same rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_documents(batch, path, batch_id, partition_by)

    w = (docs.writeStream.outputMode("append").queryName(name).foreachBatch(write)
         .option("checkpointLocation", own_checkpoint(docs.sparkSession, path, checkpoint)))
    return _trigger(w, trigger).start()


def start_memory_sink(df: DataFrame, name: str, mode: str = "append", trigger: str = "availableNow",
                      checkpoint: str | None = None) -> StreamingQuery:
    """In-memory table for tests and previews (SNK10)."""
    w = (df.writeStream.format("memory").outputMode(mode).queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_path(df.sparkSession, name)))
    return _trigger(w, trigger).start()


def run_to_end(q: StreamingQuery, timeout_s: float = 600) -> StreamingQuery:
    """Wait for an availableNow query to finish."""
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.processAllAvailable()
        q.stop()
    if q.exception():
        raise q.exception()
    return q


def dropped_by_watermark(q: StreamingQuery) -> int:
    """STR5: rows dropped as too late, summed over the query's recent progress."""
    n = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []) or []:
            n += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return n


def input_rows(q: StreamingQuery) -> int:
    """SNK10: rows read over the query's recent progress."""
    return sum(int(p.get("numInputRows", 0) or 0) for p in q.recentProgress)


Job = Callable[[SparkSession], StreamingQuery]
