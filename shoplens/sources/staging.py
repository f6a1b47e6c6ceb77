"""Test tables → the domain's streams and tables (rules in FIXTURES.md part B).

Every staged frame is a plain projection / join of the given tables, so its size grows with them and Catalyst
prunes it to the columns a query reads.  The same arithmetic is written in the DuckDB oracle
(``shoplens.plans.oracle``).  Requires the session time zone to be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import minute_of, record_json, text_to_timestamp
from shoplens.sources.tables import Tables

# Generator domains of the device logs, indexed by a key modulo the list length.
AREAS = ["beijing", "shanghai", "guangdong", "hebei", "heilongjiang", "shandong", "tianjin", "shan3xi",
         "shan1xi", "sichuan"]
CHANNELS = ["xiaomi", "huawei", "wandoujia", "360", "tencent", "baidu", "website"]
VERSIONS = ["1.2.0", "1.1.2", "1.1.3", "1.1.1"]
# Test event type → device event id.
EVID_OF_EVENT_TYPE = {"signup": "coupon", "click": "clickItem", "view": "addFavor", "purchase": "addCart",
                      "error": "addComment"}
OTHER_EVID = "share"  # every third error: an event id that no rule knows
APP_ID = "app1"
IOS_CHANNEL = "appstore"
DATABASE = "shop"
BIRTHDAY_BASE = "1960-01-01"


Days = tuple[str | None, str | None]


def _within_days(ntz_col: str, days: Days | None) -> Column | None:
    """Day range [first, last] (inclusive, ``yyyy-MM-dd``, either end open) as a predicate on a raw TIMESTAMP_NTZ
    column, so parquet receives it as a pushed filter."""
    if days is None:
        return None
    first, last = days
    cond = F.lit(True)
    if first is not None:
        cond = cond & (F.col(ntz_col) >= F.expr(f"TIMESTAMP_NTZ '{first} 00:00:00'"))
    if last is not None:
        cond = cond & (F.col(ntz_col) < F.expr(f"TIMESTAMP_NTZ '{last} 00:00:00' + INTERVAL 1 DAY"))
    return cond


def _pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _epoch_ms(ntz: Column) -> Column:
    return F.unix_millis(ntz.cast("timestamp"))


def _device_fields(user_id: Column) -> dict[str, Column]:
    os_ = F.when(user_id % 10 < 3, F.lit("ios")).otherwise(F.lit("android"))
    return {
        "appid": F.lit(APP_ID),
        "area": _pick(AREAS, user_id),
        "os": os_,
        "ch": F.when(os_ == "ios", F.lit(IOS_CHANNEL)).otherwise(_pick(CHANNELS, user_id)),
        "vs": _pick(VERSIONS, user_id),
    }


def startup(t: Tables, days: Days | None = None) -> DataFrame:
    """Start logs: one per test event, device ``mid_<user_id>``.  ``days`` keeps logs whose ``logdate`` is in the
    range (the UTC date of the raw time, so the filter is pushed to the scan)."""
    e = t.events
    cond = _within_days("ts", days)
    if cond is not None:
        e = e.where(cond)
    uid = F.col("user_id")
    dev = _device_fields(uid)
    return e.select(
        F.concat(F.lit("mid_"), uid.cast("string")).alias("mid"),
        uid.cast("string").alias("uid"),
        dev["appid"].alias("appid"), dev["area"].alias("area"), dev["os"].alias("os"), dev["ch"].alias("ch"),
        F.lit("startup").alias("type"), dev["vs"].alias("vs"),
        _epoch_ms(F.col("ts")).alias("ts"))


def _event_columns() -> list[Column]:
    uid = F.col("user_id")
    eid = F.col("event_id")
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    evid = F.lit(None).cast("string")
    for src, dst in EVID_OF_EVENT_TYPE.items():
        evid = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(evid)
    evid = F.when((F.col("event_type") == "error") & (eid % 3 == 0), F.lit(OTHER_EVID)).otherwise(evid)
    dev = _device_fields(uid)
    return [
        F.concat(F.lit("mid_"), (k % 10).cast("string")).alias("mid"),
        uid.cast("string").alias("uid"),
        dev["appid"].alias("appid"), dev["area"].alias("area"), dev["os"].alias("os"),
        F.lit("event").alias("type"),
        evid.alias("evid"),
        (eid % 50 + 1).cast("string").alias("pgid"),
        (eid * 7 % 50 + 1).cast("string").alias("npgid"),
        (eid % 50).cast("string").alias("itemid"),
        _epoch_ms(F.col("ts")).alias("ts"),
    ]


def event_log(t: Tables) -> DataFrame:
    """Event logs: device ``mid_<k % 10>`` (k from props), so ten busy devices share all users."""
    return t.events.select(*_event_columns())


def raw_logs(t: Tables) -> DataFrame:
    """Both log kinds before routing (schema RAW_LOG); logs of ``error`` events carry a null ``type``."""
    s = startup(t).select("type", "mid", "uid", "appid", "area", "os", "ch", "vs",
                          *[F.lit(None).cast("string").alias(c) for c in ("evid", "pgid", "npgid", "itemid")],
                          "ts")
    ev = t.events.select(F.col("event_type"), *_event_columns())
    ev = ev.select(F.when(F.col("event_type") != "error", F.col("type")).alias("type"),
                   "mid", "uid", "appid", "area", "os", F.lit(None).cast("string").alias("ch"),
                   F.lit(None).cast("string").alias("vs"), "evid", "pgid", "npgid", "itemid", "ts")
    return s.unionByName(ev)


def _create_ts(orderkey: Column, orderdate: Column) -> Column:
    return F.timestamp_add("SECOND", (orderkey * 7919) % 86400, orderdate)


def order_info(t: Tables, days: Days | None = None, customer: bool = True) -> DataFrame:
    """Orders enriched with their customer (without, its three columns are null and no join is needed); create_time = order date + a key-derived time of day (under 24 h), so
    ``days`` on ``create_date`` is the same range on the raw order date, pushed to the scan."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    cond = _within_days("o_orderdate", days)
    if cond is not None:
        o = o.where(cond)
    if customer:
        c = t.customer.select("c_custkey", "c_name", "c_nationkey")
        j = o.join(c, o.o_custkey == c.c_custkey, "left")
    else:
        j = o.select("*", *[F.lit(None).cast(k).alias(n) for n, k in (("c_custkey", "long"), ("c_name", "string"), ("c_nationkey", "int"))])
    tel = F.concat(F.lit("1"), F.lpad(((F.col("c_custkey") * 7919 + 3456789) % 10000000000).cast("string"), 10, "0"))
    null = F.lit(None).cast("string")
    return j.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("c_nationkey").cast("string").alias("province_id"),
        F.col("c_name").alias("consignee"),
        null.alias("order_comment"),
        tel.alias("consignee_tel"),
        F.col("o_orderstatus").alias("order_status"),
        (F.col("o_orderkey") % 3 + 1).cast("string").alias("payment_way"),
        F.col("o_custkey").cast("string").alias("user_id"),
        null.alias("img_url"),
        F.col("o_totalprice").alias("total_amount"),
        null.alias("expire_time"), null.alias("delivery_address"),
        F.date_format(_create_ts(F.col("o_orderkey"), F.col("o_orderdate")), "yyyy-MM-dd HH:mm:ss")
        .alias("create_time"),
        null.alias("operate_time"), null.alias("tracking_no"), null.alias("parent_order_id"),
        null.alias("out_trade_no"), null.alias("trade_body"))


def order_detail(t: Tables, days: Days | None = None) -> DataFrame:
    """Order lines; ``detail_time`` = the order's create time ± up to 150 s (about 2/3 inside a 100 s TTL).
    ``days`` keeps lines of orders created in the range (pushed to the orders scan)."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice")
    o = t.orders.select("o_orderkey", "o_orderdate")
    cond = _within_days("o_orderdate", days)
    if cond is not None:
        o = o.where(cond)
    p = t.part.select("p_partkey", "p_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner").join(p, li.l_partkey == p.p_partkey, "left")
    qty = F.col("l_quantity").cast("long").cast("string")
    offset = (F.col("l_partkey") * 31 + F.col("l_linenumber") * 17) % 300 - 150
    detail_ts = F.timestamp_add("SECOND", offset, _create_ts(F.col("o_orderkey"), F.col("o_orderdate")))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), qty).alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("order_price"),
        F.lit(None).cast("string").alias("img_url"),
        qty.alias("sku_num"),
        F.date_format(detail_ts, "yyyy-MM-dd HH:mm:ss").alias("detail_time"))


def user_log(t: Tables) -> DataFrame:
    """User change log: ``1 + custkey % 3`` versions per customer, ``seq`` increasing."""
    c = t.customer.select("c_custkey", "c_name")
    v = c.select("c_custkey", "c_name",
                 F.explode(F.sequence(F.lit(1).cast("long"), 1 + F.col("c_custkey") % 3)).alias("seq"))
    return v.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("login_name"),
        ((F.col("c_custkey") + F.col("seq")) % 5 + 1).cast("string").alias("user_level"),
        F.date_format(F.date_add(F.to_date(F.lit(BIRTHDAY_BASE)), ((F.col("c_custkey") * 37) % 18000).cast("int")),
                      "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("seq"))


def _after(*names: str, **exprs: Column) -> Column:
    """After-image: (column name, value as text) for each column; ``exprs`` override how a value is rendered."""
    return F.array(*[F.struct(F.lit(n).alias("name"), exprs.get(n, F.col(n)).cast("string").alias("value"))
                     for n in names])


ORDER_AFTER = ("id", "province_id", "consignee", "consignee_tel", "order_status", "payment_way", "user_id",
               "total_amount", "create_time")
DETAIL_AFTER = ("id", "order_id", "sku_name", "sku_id", "order_price", "sku_num")
USER_AFTER = ("id", "login_name", "user_level", "birthday", "gender")


def change_log(t: Tables, database: str = DATABASE, arrival: bool = False) -> DataFrame:
    """Change events of the three source tables (schema CHANGE_EVENT); with ``arrival``, the ``timestamp``, ``partition``
    and ``offset`` their messages carry: an order's create time, a line's arrival, a user version's number as time.  The
    log has two partitions with offsets of their own: a user's versions alternate, those of partition 0 standing far on.

    INSERT by default; every 10th order an UPDATE; user versions after the first UPDATE, the last version of every
    25th user a DELETE; every 20th entry a transaction marker, not ROWDATA.
    """
    def entry(key: Column) -> Column:
        return F.when(key % 20 == 7, F.lit("TRANSACTIONEND")).otherwise(F.lit("ROWDATA"))

    oi = order_info(t)
    okey = F.col("id").cast("long")
    orders = oi.select(
        F.lit("order_info").alias("table_name"), entry(okey).alias("entry_type"),
        F.when(okey % 10 == 0, F.lit("UPDATE")).otherwise(F.lit("INSERT")).alias("event_type"),
        _after(*ORDER_AFTER, total_amount=F.col("total_amount").cast("decimal(18,2)")).alias("after"),
        text_to_timestamp("create_time").alias("timestamp"), (okey % 2).cast("int").alias("partition"), okey.alias("offset"))
    od = order_detail(t)
    dkey = F.col("order_id").cast("long") + F.split_part(F.col("id"), F.lit("-"), F.lit(2)).cast("long")
    details = od.select(
        F.lit("order_detail").alias("table_name"), entry(dkey).alias("entry_type"),
        F.lit("INSERT").alias("event_type"), _after(*DETAIL_AFTER).alias("after"),
        text_to_timestamp("detail_time").alias("timestamp"), (dkey % 2).cast("int").alias("partition"), dkey.alias("offset"))
    ul = user_log(t)
    ukey = F.col("id").cast("long")
    last = F.col("seq") == 1 + ukey % 3
    users = ul.select(
        F.lit("user_info").alias("table_name"), entry(ukey * 3 + F.col("seq")).alias("entry_type"),
        F.when((ukey % 25 == 0) & last, F.lit("DELETE")).when(F.col("seq") > 1, F.lit("UPDATE"))
        .otherwise(F.lit("INSERT")).alias("event_type"),
        _after(*USER_AFTER).alias("after"),
        F.timestamp_seconds(F.col("seq")).alias("timestamp"), ((ukey + F.col("seq")) % 2).cast("int").alias("partition"),
        (F.col("seq") + F.when((ukey + F.col("seq")) % 2 == 0, 900).otherwise(0)).cast("long").alias("offset"))
    out = orders.unionByName(details).unionByName(users)
    return out.select(F.concat_ws(".", F.lit(database), F.col("table_name")).alias("db_table"), "table_name",
                      "entry_type", "event_type", "after", *(["timestamp", "partition", "offset"] if arrival else []))


def doc_versions(t: Tables) -> DataFrame:
    """Keyed documents written several times: ``2 + event_id % 2`` versions of each event's alert-like document
    ``<mid>-<minute>``, with increasing ``batch_id`` (several events of one device-minute share a key)."""
    ev = t.events.select(F.col("event_id"), *_event_columns())
    v = ev.select("*", F.explode(F.sequence(F.lit(1).cast("long"), 2 + F.col("event_id") % 2)).alias("batch_id"))
    return v.select(
        F.concat_ws("-", F.col("mid"), minute_of("ts").cast("string")).alias("doc_id"),
        "batch_id", "ts", "mid", "uid", "evid",
        F.concat(F.col("evid"), F.lit("#"), F.col("batch_id").cast("string")).alias("note"))


def order_json(t: Tables) -> DataFrame:
    """Order payloads as they arrive on the order topic: JSON text; every 100th order is cut in half
    (a malformed record for the quarantine path)."""
    oi = order_info(t)
    js = record_json(*oi.columns)
    cut = F.col("id").cast("long") % 100 == 0
    return oi.select(
        F.when(cut, F.substring(js, 1, (F.length(js) / 2).cast("int"))).otherwise(js).alias("value"))
