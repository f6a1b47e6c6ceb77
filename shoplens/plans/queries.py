"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole test tables.

Fixed parameters are the dashboard's inputs (a day, a keyword, a page).  Outputs carry only strings, integers,
dates as text and doubles cast from exact decimals, so the DuckDB oracle (``plans.oracle``) can hash-compare them;
arrays and maps are emitted as sorted joined text.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import sinks
from shoplens.operators import alerts, dashboard, dau, gmv, publisher, routing, sales, search_index
from shoplens.operators.dims import latest_users, version_order
from shoplens.operators.keyed import latest_by_key
from shoplens.schemas import ORDER_INFO, TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO, TOPIC_USER_INFO
from shoplens.session import checkpoint_path, ensure_utc
from shoplens.sinks import keyed_table
from shoplens.sources import ingest, staging
from shoplens.sources.tables import Tables
from shoplens.streaming import jobs

# Fixed query parameters (non-empty at sf 0.01).
EVENT_DATE = "2024-01-15"
NEW_DEVICE_DATE = "2024-01-02"
ORDER_DATE = "1996-09-17"
SEARCH_DATE = "1995-07-25"
SEARCH_KEYWORD = "bolt"
AS_OF = "2026-01-01"
PAGE_START = 5
PAGE_SIZE = 5
TOP_N = 10
MATCH_QUERY = "building machinery"
TWIN_TTL_SECONDS = 1000
PREVIEW_ROWS = 100
WIDE_WINDOW_SECONDS, WIDE_SLIDE_SECONDS = 14400, 300  # windows in which the test data has many alerts
MIDDLE_TTL_SECONDS = 120  # between the default and the widest offset of the test data
PAIRS_FROM = "1996-06-01"
SEARCH_LEVEL = "3"
DEEP_START = 80
RANKED_QUERY = "public license data"

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    ensure_utc(spark)
    return Tables(spark, sf_dir)


# ---- daily active devices -------------------------------------------------------------------------------------

def _dau_rows(t: Tables, days: staging.Days | None = None) -> DataFrame:
    return dau.daily_active(staging.startup(t, days))


def _two_days(date: str) -> staging.Days:
    from shoplens.operators.dashboard import _yesterday
    return (_yesterday(date), date)


def q_dau_first_log(spark, sf_dir):
    return _dau_rows(_t(spark, sf_dir))


def q_dau_first_log_window(spark, sf_dir):
    return dau.first_log_per_device(dau.with_log_time(staging.startup(_t(spark, sf_dir))), method="window")


def _dau_times(t: Tables, days: staging.Days | None = None) -> DataFrame:
    return dau.first_times(staging.startup(t, days))


def q_dau_total(spark, sf_dir):
    return dau.dau_total(_dau_times(_t(spark, sf_dir), (EVENT_DATE, EVENT_DATE)), EVENT_DATE)


def q_dau_hours(spark, sf_dir):
    return dau.dau_hours(_dau_times(_t(spark, sf_dir), (EVENT_DATE, EVENT_DATE)), EVENT_DATE)


def q_dau_seen_filter(spark, sf_dir):
    """Each day in two batches: the morning's devices form the seen set; the afternoon keeps unseen devices."""
    morning, afternoon = dau.split_at_noon(staging.startup(_t(spark, sf_dir)))
    seen = dau.seen_set(dau.daily_active(morning))
    return dau.daily_active(afternoon, seen).select("mid", "logdate", "loghour", "ts", "uid")


def q_dau_new_devices(spark, sf_dir):
    return dau.new_devices(_dau_times(_t(spark, sf_dir), (None, NEW_DEVICE_DATE)), NEW_DEVICE_DATE)


def q_dau_compare_hours(spark, sf_dir):
    rows = _dau_times(_t(spark, sf_dir), _two_days(EVENT_DATE))
    return dashboard.compare_hours(rows, EVENT_DATE, "logdate", "loghour", None, "long")


def q_dau_hour_map(spark, sf_dir):
    rows = _dau_times(_t(spark, sf_dir), _two_days(EVENT_DATE))
    return dashboard.hour_map(rows, EVENT_DATE, "logdate", "loghour", None) \
        .select("which", "day", "hour_text", F.col("n_hours").cast("long").alias("n_hours"))


# ---- orders / GMV -----------------------------------------------------------------------------------------------

def _orders_clean(t: Tables, mask: str = "prefix4", days: staging.Days | None = None, customer: bool = True) -> DataFrame:
    return gmv.clean_orders(staging.order_info(t, days, customer), mask)


def q_orders_clean(spark, sf_dir):
    return gmv.table_columns(_orders_clean(_t(spark, sf_dir)))


def q_orders_clean_middle4(spark, sf_dir):
    return gmv.table_columns(_orders_clean(_t(spark, sf_dir), "middle4"))


def q_gmv_total(spark, sf_dir):
    return gmv.gmv_total(_orders_clean(_t(spark, sf_dir), days=(ORDER_DATE, ORDER_DATE), customer=False), ORDER_DATE)


def q_gmv_hours(spark, sf_dir):
    return gmv.gmv_hours(_orders_clean(_t(spark, sf_dir), days=(ORDER_DATE, ORDER_DATE), customer=False), ORDER_DATE)


def q_gmv_compare_hours(spark, sf_dir):
    orders = _orders_clean(_t(spark, sf_dir), days=_two_days(ORDER_DATE), customer=False)
    return dashboard.compare_hours(orders, ORDER_DATE, "create_date", "create_hour", F.col("total_amount"), "double")


def q_gmv_hour_map(spark, sf_dir):
    orders = _orders_clean(_t(spark, sf_dir), days=_two_days(ORDER_DATE), customer=False)
    return dashboard.hour_map(orders, ORDER_DATE, "create_date", "create_hour", F.col("total_amount")) \
        .select("which", "day", "hour_text", F.col("n_hours").cast("long").alias("n_hours"))


def q_kpi_total(spark, sf_dir):
    t = _t(spark, sf_dir)
    return dashboard.kpi_total(_dau_times(t, (None, EVENT_DATE)), _orders_clean(t, days=(ORDER_DATE, ORDER_DATE), customer=False),
                               EVENT_DATE, ORDER_DATE)


# ---- the dashboard over the stored tables ----------------------------------------------------------------------

# (application id, checkpoint folder, sf_dir) → the stored tables written from that directory in this application
_STORED: dict[tuple[str, str, str], tuple[str, str]] = {}


def _stored_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """SNK1 + SNK2: write the whole DAU table and order table, day-partitioned, into a fresh folder of the shared
    checkpoint folder; the publisher queries read them back (SRC5), pruned to the days they ask for (FLT3).

    The test tables are read-only, so the tables written from one directory are written once per application and
    shared by the three publisher queries (the stored tables play the part of the streaming jobs' output)."""
    t = _t(spark, sf_dir)
    key = (spark.sparkContext.applicationId, checkpoint_path(spark, ""), os.path.abspath(sf_dir))
    if key not in _STORED:
        root = checkpoint_path(spark, f"stored-{uuid.uuid4().hex}")
        dau_path, orders_path = os.path.join(root, "dau"), os.path.join(root, "order_info")
        sinks.write_dau_table(_dau_rows(t), dau_path)
        sinks.write_order_table(_orders_clean(t), orders_path)
        _STORED[key] = (dau_path, orders_path)
    return _STORED[key]


def q_stored_kpi_total(spark, sf_dir):
    return publisher.realtime_total(spark, *_stored_tables(spark, sf_dir), EVENT_DATE, ORDER_DATE)


def q_stored_dau_hours(spark, sf_dir):
    return publisher.realtime_hours(spark, *_stored_tables(spark, sf_dir), "dau", EVENT_DATE)


def q_stored_gmv_hours(spark, sf_dir):
    return publisher.realtime_hours(spark, *_stored_tables(spark, sf_dir), "order_amount", ORDER_DATE)


ROLLED_BATCHES = 3


def _rolled_tables(spark, sf_dir, logs: bool = True, orders: bool = True) -> tuple[str, str]:
    """The roll-ups that the DAU and order jobs leave, from the whole tables in three micro-batches."""
    t = _t(spark, sf_dir)
    root = checkpoint_path(spark, f"rolled-{uuid.uuid4().hex}")
    dau_path, orders_path = f"{root}/dau", f"{root}/orders"
    for batch in range(ROLLED_BATCHES):
        if logs:
            rows = dau.with_log_time(staging.startup(t)).where(F.pmod(F.col("ts"), F.lit(ROLLED_BATCHES)) == batch)
            jobs.store_dau_batch(rows, dau_path, batch, buckets=1)
        if orders:
            rows = _orders_clean(t, customer=False).where(F.pmod(F.col("id").cast("long"), F.lit(ROLLED_BATCHES)) == batch)
            jobs.store_order_amounts(rows, orders_path, batch)
    return dau_path, orders_path


def q_rollup_kpi_total(spark, sf_dir):
    """The KPI list from roll-ups alone."""
    return publisher.rollup_total(spark, *_rolled_tables(spark, sf_dir), EVENT_DATE, ORDER_DATE)


def q_rollup_gmv_hours(spark, sf_dir):
    return publisher.rollup_hours(spark, *_rolled_tables(spark, sf_dir, logs=False), "order_amount", ORDER_DATE)


# ---- coupon alert ------------------------------------------------------------------------------------------------

def _alert_out(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "index_name", "mid", "window_start", "ts",
                     F.array_join("uids", ",").alias("uids"), F.array_join("item_ids", ",").alias("item_ids"),
                     F.size("uids").cast("long").alias("n_uids"), "events", "n_events")


def q_coupon_alert(spark, sf_dir):
    return _alert_out(alerts.coupon_alerts(staging.event_log(_t(spark, sf_dir)), prefilter=True))


def q_coupon_alert_naive(spark, sf_dir):
    return _alert_out(alerts.coupon_alerts(staging.event_log(_t(spark, sf_dir)), prefilter=False))


def q_coupon_alert_panes(spark, sf_dir):
    """The same alerts, folded through 5-second panes before the window expansion (the dense-feed form)."""
    return _alert_out(alerts.coupon_alerts(staging.event_log(_t(spark, sf_dir)), prefilter=True, panes=True))


def q_coupon_alert_two_phase(spark, sf_dir):
    """The same alerts, firing decided by fixed-width aggregates before any set is collected (hot-device form)."""
    return _alert_out(alerts.coupon_alerts(staging.event_log(_t(spark, sf_dir)), prefilter=True, two_phase=True))


def q_coupon_alert_strict(spark, sf_dir):
    """The '> 3 users' rule of the twin job."""
    return _alert_out(alerts.coupon_alerts(staging.event_log(_t(spark, sf_dir)), min_uids=4))


def _wide_alerts(spark, sf_dir, min_uids: int) -> DataFrame:
    return _alert_out(alerts.coupon_alerts(staging.event_log(_t(spark, sf_dir)), WIDE_WINDOW_SECONDS, WIDE_SLIDE_SECONDS, min_uids))


def q_coupon_alert_strict_wide(spark, sf_dir):
    """The '> 3 users' rule over four-hour windows, where it fires."""
    return _wide_alerts(spark, sf_dir, 4)


def q_alert_preview_wide(spark, sf_dir):
    """ORD2 over four-hour windows, which give more alerts than the preview shows."""
    return alerts.preview(_wide_alerts(spark, sf_dir, alerts.DEFAULT_MIN_UIDS).orderBy("doc_id"), PREVIEW_ROWS)


def q_alert_preview(spark, sf_dir):
    """ORD2: the first 100 alert documents (in document-id order, so the preview is the same on every run)."""
    docs = _alert_out(alerts.coupon_alerts(staging.event_log(_t(spark, sf_dir))))
    return alerts.preview(docs.orderBy("doc_id"), PREVIEW_ROWS)


# ---- order / detail joins and the user dimension ----------------------------------------------------------------

def q_order_detail_pairs(spark, sf_dir):
    t = _t(spark, sf_dir)
    return sales.detail_pairs(staging.order_info(t, customer=False), staging.order_detail(t))


def q_order_detail_pairs_since(spark, sf_dir):
    """Orders from a day on against all lines: lines of earlier orders are ``detail_only``."""
    t = _t(spark, sf_dir)
    return sales.detail_pairs(staging.order_info(t, (PAIRS_FROM, None), customer=False), staging.order_detail(t))


def _sale_details(t: Tables, ttl: int = sales.DEFAULT_TTL_SECONDS, days: staging.Days | None = None) -> DataFrame:
    """Sale details; ``days`` restricts both sides to orders created in the range (a sale's ``dt`` is its order's
    create date, so a day's search needs no other order or line)."""
    return sales.sale_details(gmv.clean_orders(staging.order_info(t, days, customer=False)), staging.order_detail(t, days), ttl)


def q_sale_detail(spark, sf_dir):
    return _sale_details(_t(spark, sf_dir))


def q_sale_detail_ttl1000(spark, sf_dir):
    return _sale_details(_t(spark, sf_dir), TWIN_TTL_SECONDS)


def q_sale_detail_ttl120(spark, sf_dir):
    return _sale_details(_t(spark, sf_dir), MIDDLE_TTL_SECONDS)


def q_sale_detail_all(spark, sf_dir):
    t = _t(spark, sf_dir)
    return sales.sale_details_all(gmv.clean_orders(staging.order_info(t, customer=False)), staging.order_detail(t))


def q_user_latest(spark, sf_dir):
    return latest_users(staging.user_log(_t(spark, sf_dir)))


def _sale_detail_user(t: Tables, days: staging.Days | None = None) -> DataFrame:
    return sales.with_user(_sale_details(t, days=days), latest_users(staging.user_log(t)), AS_OF)


def q_sale_detail_user(spark, sf_dir):
    return _sale_detail_user(_t(spark, sf_dir))


def q_sale_search(spark, sf_dir):
    rows = _sale_detail_user(_t(spark, sf_dir), (SEARCH_DATE, SEARCH_DATE))
    return dashboard.sale_search(rows, SEARCH_DATE, SEARCH_KEYWORD)


def q_sale_search_level(spark, sf_dir):
    """FLT7 over every day, for one user level."""
    return dashboard.sale_search(_sale_detail_user(_t(spark, sf_dir)), None, SEARCH_KEYWORD, SEARCH_LEVEL)


def q_sale_search_page(spark, sf_dir):
    rows = _sale_detail_user(_t(spark, sf_dir), (SEARCH_DATE, SEARCH_DATE))
    hits = dashboard.sale_search(rows, SEARCH_DATE, SEARCH_KEYWORD)
    return dashboard.page(hits, PAGE_START, PAGE_SIZE)


def q_sale_search_deep_page(spark, sf_dir):
    """ORD1 far behind the first page, over the stored hits of every day."""
    path = checkpoint_path(spark, f"hits-{uuid.uuid4().hex}")
    q_sale_search_level(spark, sf_dir).hint("rebalance").sortWithinPartitions("dt", "order_detail_id").write.parquet(path)
    return dashboard.page_by_ranges(spark.read.parquet(path), DEEP_START, PAGE_SIZE)


def q_gender_share(spark, sf_dir):
    return dashboard.gender_share(_sale_detail_user(_t(spark, sf_dir)))


def q_age_share(spark, sf_dir):
    return dashboard.age_share(_sale_detail_user(_t(spark, sf_dir)))


def q_region_sales(spark, sf_dir):
    t = _t(spark, sf_dir)
    return dashboard.region_sales(staging.order_info(t), t.nation, t.region)


def q_product_top(spark, sf_dir):
    return dashboard.product_top(staging.order_detail(_t(spark, sf_dir)), TOP_N)


def q_match_search(spark, sf_dir):
    return dashboard.match_search(_t(spark, sf_dir).customer, "c_mktsegment", MATCH_QUERY, "c_custkey", TOP_N)


def q_match_max(spark, sf_dir):
    return dashboard.match_max(_t(spark, sf_dir).customer, "c_mktsegment", MATCH_QUERY, "c_acctbal")


def q_match_ranked(spark, sf_dir):
    """FLT6 by relevance, over an index of all documents."""
    path = checkpoint_path(spark, f"index-{uuid.uuid4().hex}")
    search_index.write_index(_t(spark, sf_dir).documents, "doc_id", "text", path)
    return search_index.match_ranked(spark, path, RANKED_QUERY, TOP_N).withColumnRenamed("key", "doc_id")


# ---- routing, ingest, keyed documents ---------------------------------------------------------------------------

def q_route_logs(spark, sf_dir):
    routed = routing.route_logs(staging.raw_logs(_t(spark, sf_dir)))
    return routed.select("topic", "type", "mid", "uid", "evid", "ts")


def q_raw_archive(spark, sf_dir):
    """SNK8 payload: every raw log as (day, JSON line)."""
    return sinks.archive_lines(staging.raw_logs(_t(spark, sf_dir)))


def q_route_changes(spark, sf_dir):
    return routing.route_changes(staging.change_log(_t(spark, sf_dir)), staging.DATABASE)


def _parsed_orders(t: Tables) -> DataFrame:
    return ingest.parse_records(staging.order_json(t), ORDER_INFO)


def q_parse_json(spark, sf_dir):
    return ingest.good_records(_parsed_orders(_t(spark, sf_dir)))


def q_parse_json_quarantine(spark, sf_dir):
    return ingest.quarantine(_parsed_orders(_t(spark, sf_dir))).select(F.length("raw").cast("long").alias("n_chars"), F.substring("raw", 1, 20).alias("head"))


# ---- change log → routing → topic → job --------------------------------------------------------------------------

def _routed(t: Tables, topic: str) -> DataFrame:
    """The messages of one topic, as the change routing writes them."""
    return routing.route_changes(staging.change_log(t, arrival=True), staging.DATABASE).where(F.col("topic") == topic)


def _topic_orders(t: Tables) -> DataFrame:
    return gmv.clean_orders(jobs.parsed(_routed(t, TOPIC_ORDER_INFO), ORDER_INFO))


def q_chain_gmv(spark, sf_dir):
    return gmv.gmv_hours(_topic_orders(_t(spark, sf_dir)), ORDER_DATE)


def q_chain_sale_detail(spark, sf_dir):
    t = _t(spark, sf_dir)
    return sales.sale_details(_topic_orders(t), jobs.order_lines(_routed(t, TOPIC_ORDER_DETAIL)))


def q_chain_user_latest(spark, sf_dir):
    users = latest_users(jobs.user_changes(_routed(_t(spark, sf_dir), TOPIC_USER_INFO)))
    # the routed payload has no version number; the change log's time is one
    return users.select("id", "login_name", "user_level", "birthday", "gender", F.unix_seconds("timestamp").alias("seq"))


def _topic_users(t: Tables) -> str:
    """The bucketed user table, as the user job writes it from its topic in three micro-batches."""
    versions = jobs.user_changes(_routed(t, TOPIC_USER_INFO))
    path = checkpoint_path(t.spark, f"users-{uuid.uuid4().hex}")
    for batch in range(3):
        keyed_table.write_keyed(versions.where(F.unix_seconds("timestamp") % 3 == batch), path, batch, jobs.USER_KEYS, version_order(versions.columns))
    return path


def q_chain_sale_detail_user(spark, sf_dir):
    """The sale job over the topics, each sale with its user from the bucketed user table.  The sales are stored once: the
    lookup reads their user ids twice and the join reads them whole."""
    t = _t(spark, sf_dir)
    path = checkpoint_path(spark, f"sales-{uuid.uuid4().hex}")
    sales.sale_details(_topic_orders(t), jobs.order_lines(_routed(t, TOPIC_ORDER_DETAIL))).write.parquet(path)
    details = spark.read.parquet(path)
    return sales.with_user(details, jobs.users_of(details, _topic_users(t)), AS_OF)


def q_latest_documents(spark, sf_dir):
    return latest_by_key(staging.doc_versions(_t(spark, sf_dir)), ["doc_id"], ["batch_id", "ts"])


QUERIES: dict[str, Query] = {
    "dau_first_log": q_dau_first_log,
    "dau_first_log_window": q_dau_first_log_window,
    "dau_total": q_dau_total,
    "dau_hours": q_dau_hours,
    "dau_seen_filter": q_dau_seen_filter,
    "dau_new_devices": q_dau_new_devices,
    "dau_compare_hours": q_dau_compare_hours,
    "dau_hour_map": q_dau_hour_map,
    "orders_clean": q_orders_clean,
    "orders_clean_middle4": q_orders_clean_middle4,
    "gmv_total": q_gmv_total,
    "gmv_hours": q_gmv_hours,
    "gmv_compare_hours": q_gmv_compare_hours,
    "gmv_hour_map": q_gmv_hour_map,
    "kpi_total": q_kpi_total,
    "stored_kpi_total": q_stored_kpi_total,
    "stored_dau_hours": q_stored_dau_hours,
    "stored_gmv_hours": q_stored_gmv_hours,
    "coupon_alert": q_coupon_alert,
    "coupon_alert_naive": q_coupon_alert_naive,
    "coupon_alert_panes": q_coupon_alert_panes,
    "coupon_alert_two_phase": q_coupon_alert_two_phase,
    "coupon_alert_strict": q_coupon_alert_strict,
    "alert_preview": q_alert_preview,
    "order_detail_pairs": q_order_detail_pairs,
    "sale_detail": q_sale_detail,
    "sale_detail_ttl1000": q_sale_detail_ttl1000,
    "sale_detail_all": q_sale_detail_all,
    "user_latest": q_user_latest,
    "sale_detail_user": q_sale_detail_user,
    "sale_search": q_sale_search,
    "sale_search_page": q_sale_search_page,
    "gender_share": q_gender_share,
    "age_share": q_age_share,
    "region_sales": q_region_sales,
    "product_top": q_product_top,
    "match_search": q_match_search,
    "match_max": q_match_max,
    "route_logs": q_route_logs,
    "raw_archive": q_raw_archive,
    "route_changes": q_route_changes,
    "parse_json": q_parse_json,
    "parse_json_quarantine": q_parse_json_quarantine,
    "latest_documents": q_latest_documents,
    "coupon_alert_strict_wide": q_coupon_alert_strict_wide,
    "alert_preview_wide": q_alert_preview_wide,
    "order_detail_pairs_since": q_order_detail_pairs_since,
    "sale_detail_ttl120": q_sale_detail_ttl120,
    "sale_search_level": q_sale_search_level,
    "chain_gmv": q_chain_gmv,
    "chain_sale_detail": q_chain_sale_detail,
    "chain_user_latest": q_chain_user_latest,
    "chain_sale_detail_user": q_chain_sale_detail_user,
    "rollup_kpi_total": q_rollup_kpi_total,
    "rollup_gmv_hours": q_rollup_gmv_hours,
    "sale_search_deep_page": q_sale_search_deep_page,
    "match_ranked": q_match_ranked,
}
