"""Hand-made edge cases for each operator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoplens.functions.columns import mask_middle4, mask_prefix4, text_date, text_hour
from shoplens.operators import alerts, dashboard, dau, gmv, routing, sales
from shoplens.operators.dims import latest_users
from shoplens.operators.keyed import latest_by_key
from shoplens.schemas import EVENT_LOG, ORDER_DETAIL, ORDER_INFO, STARTUP_LOG, USER_INFO
from shoplens.sources import ingest

T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC in ms


def _ev(spark, rows):
    full = [dict(mid=r[0], uid=r[1], appid="a", area="x", os="ios", type="event", evid=r[2], pgid="1",
                 npgid="1", itemid=r[3], ts=r[4]) for r in rows]
    return spark.createDataFrame(full, EVENT_LOG)


def _alerts(df, **kw):
    a = alerts.coupon_alerts(df, prefilter=True, **kw).collect()
    b = alerts.coupon_alerts(df, prefilter=False, **kw).collect()
    key = lambda r: r["doc_id"]
    assert sorted(a, key=key) == sorted(b, key=key)
    return a


# ---- alerts -------------------------------------------------------------------------------------------------------

def test_alert_three_users_fires_once_per_minute(spark):
    df = _ev(spark, [("m1", "u1", "coupon", "7", T0 + 1000), ("m1", "u2", "coupon", "8", T0 + 2000),
                     ("m1", "u3", "coupon", "7", T0 + 3000)])
    out = _alerts(df)
    assert len(out) > 0
    assert all(sorted(r["uids"]) == ["u1", "u2", "u3"] for r in out)
    assert all(r["item_ids"] == ["7", "8"] for r in out)
    # one document per (device, minute), the last window ending in that minute
    assert len({r["doc_id"] for r in out}) == len(out)
    for r in out:
        assert r["doc_id"] == f"m1-{r['ts'] // 60000}"
    # every window ending in the first minute that holds all three coupons fires; the last of them is kept
    first_minute = min(out, key=lambda r: r["ts"])
    assert first_minute["ts"] == (first_minute["ts"] // 60000) * 60000 + 55000


def test_alert_two_users_does_not_fire(spark):
    df = _ev(spark, [("m1", "u1", "coupon", "7", T0 + 1000), ("m1", "u2", "coupon", "8", T0 + 2000),
                     ("m1", "u2", "coupon", "9", T0 + 3000)])
    assert _alerts(df) == []


def test_alert_strict_rule_needs_four(spark):
    df = _ev(spark, [("m1", f"u{i}", "coupon", "1", T0 + i * 1000) for i in range(3)])
    assert _alerts(df, min_uids=4) == []
    assert len(_alerts(df, min_uids=3)) > 0


def test_alert_click_inside_window_suppresses(spark):
    rows = [("m1", f"u{i}", "coupon", "1", T0 + 60_000 + i * 1000) for i in range(3)]
    rows.append(("m1", "u9", "clickItem", "1", T0 + 61_500))
    assert _alerts(_ev(spark, rows)) == []


def test_alert_click_outside_window_does_not_suppress(spark):
    rows = [("m1", f"u{i}", "coupon", "1", T0 + 600_000 + i * 1000) for i in range(3)]
    rows.append(("m1", "u9", "clickItem", "1", T0 + 600_000 - 300_001))
    out = _alerts(_ev(spark, rows))
    assert len(out) > 0
    # the click is older than 5 minutes for every window that holds all three coupons
    assert all(r["window_start"] > T0 + 600_000 - 300_001 for r in out)


def test_alert_users_across_bucket_edge(spark):
    # three users spread over two adjacent 5-minute buckets still fire (the pre-filter must keep them)
    edge = T0 + 300_000
    rows = [("m1", "u1", "coupon", "1", edge - 2000), ("m1", "u2", "coupon", "1", edge + 1000),
            ("m1", "u3", "coupon", "1", edge + 2000)]
    assert len(_alerts(_ev(spark, rows))) > 0


def test_alert_devices_are_separate(spark):
    rows = [("m1", "u1", "coupon", "1", T0 + 1000), ("m2", "u2", "coupon", "1", T0 + 2000),
            ("m3", "u3", "coupon", "1", T0 + 3000)]
    assert _alerts(_ev(spark, rows)) == []


def test_alert_candidates_superset(spark):
    rows = [("m1", f"u{i}", "coupon", "1", T0 + i * 200_000) for i in range(6)]
    df = _ev(spark, rows)
    cands = {(r["mid"], r["bucket"]) for r in alerts.candidate_buckets(df).collect()}
    fired = _alerts(df)
    for r in fired:
        b0 = r["window_start"] // 300_000
        assert ("m1", b0) in cands


# ---- DAU ------------------------------------------------------------------------------------------------------------

def _starts(spark, rows):
    full = [dict(mid=m, uid="1", appid="a", area="x", os="ios", ch="c", type="startup", vs="1", ts=t)
            for m, t in rows]
    return spark.createDataFrame(full, STARTUP_LOG)


def test_first_log_equal_ts_one_row(spark):
    df = _starts(spark, [("m1", T0 + 5), ("m1", T0 + 5), ("m1", T0 + 9)])
    for method in ("aggregate", "window"):
        out = dau.first_log_per_device(df, method=method).collect()
        assert len(out) == 1 and out[0]["ts"] == T0 + 5


def test_dau_unique_and_hours_sum_to_total(spark):
    rows = [("m%d" % (i % 7), T0 + i * 3_600_000 // 3) for i in range(200)]
    d = dau.daily_active(_starts(spark, rows))
    assert d.count() == d.select("mid", "logdate").distinct().count()
    day = "2024-01-02"
    total = dau.dau_total(d, day).collect()[0]["dau"]
    hours = sum(r["dau"] for r in dau.dau_hours(d, day).collect())
    assert total == hours


def test_seen_filter_drops_seen_device_same_day_only(spark):
    logs = _starts(spark, [("m1", T0 + 1000), ("m2", T0 + 2000), ("m1", T0 + 86_400_000 + 5)])
    seen = dau.seen_set(dau.daily_active(_starts(spark, [("m1", T0)])))
    out = {(r["mid"], r["logdate"]) for r in dau.daily_active(logs, seen).collect()}
    assert out == {("m2", "2024-01-01"), ("m1", "2024-01-02")}


def test_new_devices(spark):
    logs = _starts(spark, [("m1", T0), ("m2", T0 + 86_400_000), ("m1", T0 + 86_400_000)])
    d = dau.daily_active(logs)
    assert dau.new_devices(d, "2024-01-02").collect()[0]["new_mid"] == 1


def test_empty_input(spark):
    d = dau.daily_active(spark.createDataFrame([], STARTUP_LOG))
    assert dau.dau_total(d, "2024-01-01").collect()[0]["dau"] == 0
    hours = dashboard.compare_hours(d, "2024-01-01", "logdate", "loghour", None, "long").collect()
    assert len(hours) == 24 and all(r["today"] == 0 and r["yesterday"] == 0 for r in hours)


# ---- orders / GMV ---------------------------------------------------------------------------------------------------

def _orders(spark, rows):
    full = [dict(id=i, consignee_tel=tel, total_amount=amt, create_time=ct, user_id=u, order_status="1")
            for i, tel, amt, ct, u in rows]
    return spark.createDataFrame(full, ORDER_INFO)


def test_masks_and_short_phones(spark):
    df = _orders(spark, [("1", "13812345678", 1.0, "2024-01-01 10:00:00", "1"), ("2", "123", 1.0, None, "1"),
                         ("3", None, 1.0, "2024-01-01 10:00:00", "1")])
    r = {x["id"]: x for x in df.select("id", mask_prefix4("consignee_tel").alias("p"),
                                       mask_middle4("consignee_tel").alias("m"),
                                       text_date("create_time").alias("d"), text_hour("create_time").alias("h"))
         .collect()}
    assert r["1"]["p"] == "1381*******" and r["1"]["m"] == "138****5678"
    assert r["2"]["p"] == "123*******" and r["2"]["m"] == "123****"
    assert r["3"]["p"] is None and r["3"]["m"] is None
    assert r["1"]["d"] == "2024-01-01" and r["1"]["h"] == "10"
    assert r["2"]["d"] is None and r["2"]["h"] is None


def test_gmv_day_without_orders_is_null(spark):
    df = gmv.clean_orders(_orders(spark, [("1", "1", 10.10, "2024-01-01 10:00:00", "1"),
                                          ("2", "1", 0.20, "2024-01-01 11:00:00", "1")]))
    assert gmv.gmv_total(df, "2024-01-01").collect()[0]["gmv"] == pytest.approx(10.30)
    assert gmv.gmv_total(df, "2024-01-05").collect()[0]["gmv"] is None
    assert gmv.table_columns(df).columns[0] == "ID"


def test_kpi_rows(spark):
    d = dau.daily_active(_starts(spark, [("m1", T0), ("m2", T0 + 10)]))
    o = gmv.clean_orders(_orders(spark, [("1", "1", 10.0, "2024-01-01 10:00:00", "1")]))
    rows = {r["id"]: r["value"] for r in dashboard.kpi_total(d, o, "2024-01-01").collect()}
    assert rows == {"dau": 2.0, "new_mid": 2.0, "order_amount": 10.0}


# ---- order / detail join --------------------------------------------------------------------------------------------

def _details(spark, rows):
    full = [dict(id=i, order_id=o, sku_name="red bolt", sku_id="9", order_price="2.50", sku_num="1", detail_time=t)
            for i, o, t in rows]
    return spark.createDataFrame(full, ORDER_DETAIL)


def test_interval_join_bounds(spark):
    o = _orders(spark, [("1", "1", 1.0, "2024-01-01 10:00:00", "7")])
    d = _details(spark, [("a", "1", "2024-01-01 09:58:20"),   # detail 100 s before the order: kept
                         ("b", "1", "2024-01-01 10:01:40"),   # exactly 100 s after: kept
                         ("c", "1", "2024-01-01 10:01:41"),   # 101 s after: dropped
                         ("d", "2", "2024-01-01 10:00:00")])  # no order: never emitted
    out = sales.sale_details(gmv.clean_orders(o), d, 100).collect()
    assert sorted(r["order_detail_id"] for r in out) == ["a", "b"]
    assert all(r["sku_price"] == 2.5 and r["dt"] == "2024-01-01" for r in out)
    assert sales.sale_details_all(gmv.clean_orders(o), d).count() == 3
    states = {r["order_detail_id"]: r["match_state"] for r in sales.detail_pairs(o, d).collect()}
    assert states == {"a": "both", "b": "both", "c": "both", "d": "detail_only"}


def test_each_pair_once_with_many_details(spark):
    o = _orders(spark, [("1", "1", 1.0, "2024-01-01 10:00:00", "7")])
    d = _details(spark, [(f"x{i}", "1", "2024-01-01 10:00:0%d" % i) for i in range(5)])
    assert sales.sale_details(gmv.clean_orders(o), d).count() == 5


def test_user_enrichment_and_missing_user(spark):
    o = _orders(spark, [("1", "1", 1.0, "2024-01-01 10:00:00", "7"), ("2", "1", 1.0, "2024-01-01 10:00:00", "8")])
    d = _details(spark, [("a", "1", "2024-01-01 10:00:00"), ("b", "2", "2024-01-01 10:00:00")])
    users = spark.createDataFrame([dict(id="7", login_name="x", user_level="1", birthday="2000-01-01", gender="F",
                                        seq=1),
                                   dict(id="7", login_name="x", user_level="3", birthday="2000-01-01", gender="F",
                                        seq=2)], USER_INFO)
    latest = latest_users(users)
    assert latest.collect()[0]["user_level"] == "3"
    out = {r["order_detail_id"]: r for r in
           sales.with_user(sales.sale_details(gmv.clean_orders(o), d), latest, "2026-01-01").collect()}
    # 9497 days / 365 = 26 (integer division of whole days)
    assert out["a"]["user_age"] == (dt.date(2026, 1, 1) - dt.date(2000, 1, 1)).days // 365
    assert out["a"]["user_gender"] == "F" and out["a"]["user_level"] == "3"
    assert out["b"]["user_age"] == 0 and out["b"]["user_gender"] is None


def test_search_and_page(spark):
    rows = spark.createDataFrame(
        [dict(order_detail_id=f"d{i:02d}", dt="2024-01-01", sku_name=n, user_level="1")
         for i, n in enumerate(["red bolt", "blue gear", "bolt", "Bolted rod", "BOLT plate"] * 3)])
    hits = dashboard.sale_search(rows, "2024-01-01", "bolt")
    assert hits.count() == 9
    pg = dashboard.page(hits, 2, 3).collect()
    assert [r["order_detail_id"] for r in pg] == ["d04", "d05", "d07"]
    assert all(r["total"] == 9 for r in pg)
    assert dashboard.sale_search(rows, None, "").count() == 15


# ---- routing, ingest, documents -------------------------------------------------------------------------------------

def test_log_routing_null_type_goes_to_events(spark):
    df = spark.createDataFrame([("startup", "m1"), ("event", "m2"), (None, "m3"), ("other", "m4")], "type string, mid string")
    out = {r["mid"]: r["topic"] for r in routing.route_logs(df).collect()}
    assert out == {"m1": "TOPIC_START", "m2": "TOPIC_EVENT", "m3": "TOPIC_EVENT", "m4": "TOPIC_EVENT"}


def test_change_routing(spark):
    after = [{"name": "id", "value": "5"}, {"name": "x", "value": None}]
    rows = [("shop.order_info", "order_info", "ROWDATA", "INSERT", after),
            ("shop.order_info", "order_info", "ROWDATA", "UPDATE", after),
            ("shop.order_detail", "order_detail", "ROWDATA", "INSERT", after),
            ("shop.user_info", "user_info", "ROWDATA", "UPDATE", after),
            ("shop.user_info", "user_info", "ROWDATA", "DELETE", after),
            ("shop.user_info", "user_info", "TRANSACTIONEND", "INSERT", after),
            ("other.order_info", "order_info", "ROWDATA", "INSERT", after)]
    from shoplens.schemas import CHANGE_EVENT
    df = spark.createDataFrame(rows, CHANGE_EVENT)
    out = routing.route_changes(df, "shop").collect()
    assert sorted(r["topic"] for r in out) == ["TOPIC_ORDER_DETAIL", "TOPIC_ORDER_INFO", "TOPIC_USER_INFO"]
    assert out[0]["value"] == '{"id":"5","x":null}' and out[0]["row_id"] == "5"


def test_malformed_json_is_quarantined(spark):
    msgs = spark.createDataFrame([('{"id":"1","total_amount":2.5}',), ('{"id":"2","tot',), ("",)], "value string")
    parsed = ingest.parse_records(msgs, ORDER_INFO)
    good = ingest.good_records(parsed).collect()
    assert [(r["id"], r["total_amount"]) for r in good] == [("1", 2.5)]
    assert ingest.quarantine(parsed).count() == 2


def test_upsert_twice_changes_nothing(spark, scratch):
    from shoplens import sinks
    docs = spark.createDataFrame([("k1", 1), ("k2", 2), (None, 3)], "doc_id string, v int")
    sinks.upsert_documents(docs, scratch + "/d", batch_id=1)
    first = sorted((r["doc_id"], r["v"]) for r in sinks.latest_documents(spark, scratch + "/d").collect()
                   if r["v"] != 3)
    sinks.upsert_documents(docs, scratch + "/d", batch_id=1)  # the same batch replayed
    again = sorted((r["doc_id"], r["v"]) for r in sinks.latest_documents(spark, scratch + "/d").collect()
                   if r["v"] != 3)
    assert first == again == [("k1", 1), ("k2", 2)]
    newer = spark.createDataFrame([("k1", 10)], "doc_id string, v int")
    sinks.upsert_documents(newer, scratch + "/d", batch_id=2)
    latest = {r["doc_id"]: r["v"] for r in sinks.latest_documents(spark, scratch + "/d").collect()}
    assert latest["k1"] == 10 and latest["k2"] == 2 and len(latest) == 3
    # documents without an id are kept, once per write of their batch
    assert spark.read.parquet(scratch + "/d").where("doc_id is null").count() == 1


def test_latest_by_key_ties_are_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z")], "k string, o int, v string")
    assert latest_by_key(df, ["k"], ["o"]).collect()[0]["v"] == "y"


def test_hour_map_and_region_sales(spark):
    d = dau.daily_active(_starts(spark, [("m1", T0), ("m2", T0 + 3_600_000), ("m3", T0 - 1000)]))
    m = {r["which"]: r for r in dashboard.hour_map(d, "2024-01-01", "logdate", "loghour", None).collect()}
    assert m["today"]["hour_text"] == "00:1.00,01:1.00" and m["yesterday"]["n_hours"] == 1
    o = _orders(spark, [("1", "1", 1.5, "2024-01-01 10:00:00", "1")]).withColumn("province_id", F.lit("3"))
    nation = spark.createDataFrame([(3, "N3", 1)], "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(1, "R1")], "r_regionkey int, r_name string")
    r = dashboard.region_sales(o, nation, region).collect()[0]
    assert (r["n_name"], r["r_name"], r["n_orders"], r["amount"], r["class_lo"]) == ("N3", "R1", 1, 1.5, 0)


def test_documents_from_json_and_archive(spark, scratch):
    from shoplens import sinks
    msgs = spark.createDataFrame([("m1", '{"movie": "a", "id": 1}'), (None, '{"movie": "b", "id": 2}')],
                                 "doc_id string, value string")
    docs = sinks.documents_from_json(msgs, "movie string, id int")
    sinks.upsert_documents(docs, scratch + "/idx", batch_id=0)
    got = sinks.latest_documents(spark, scratch + "/idx").collect()
    assert sorted(r["movie"] for r in got) == ["a", "b"]
    assert sorted(str(r["doc_id"]) for r in got) == ["None", "m1"]
    logs = spark.createDataFrame([("startup", "m1", T0), ("event", "m2", T0 + 86_400_000)],
                                 "type string, mid string, ts long")
    sinks.archive_logs(logs, scratch + "/archive")
    arch = spark.read.text(scratch + "/archive")
    assert sorted(str(r["dt"]) for r in arch.select("dt").collect()) == ["2024-01-01", "2024-01-02"]
    routed = routing.route_logs(logs)
    sinks.write_topics(routed, scratch + "/topics")
    assert {r["topic"] for r in spark.read.text(scratch + "/topics").select("topic").collect()} == {
        "TOPIC_START", "TOPIC_EVENT"}


def test_match_search_total_and_hits(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["我是中国人", "red bolt", "Bolt", "gear", "中国"])],
                                 "id long, text string")
    hits = dashboard.match_search(docs, "text", "bolt", "id", 1).collect()
    assert [(r["id"], r["total"]) for r in hits] == [(1, 2)]
    cjk = dashboard.match_search(docs, "text", "中国", "id", 10).collect()
    assert [r["id"] for r in cjk] == [0, 4]
    mx = dashboard.match_max(docs, "text", "bolt gear", "id").collect()[0]
    assert (mx["total"], mx["max_id"]) == (3, 3)


def test_small_helpers(spark):
    from shoplens import sinks
    from shoplens.functions.columns import previous_day, receive_stamp
    df = spark.createDataFrame([("2024-03-01",), ("2024-01-01",)], "d string")
    got = sorted(r["p"] for r in df.select(previous_day("d").alias("p")).collect())
    assert got == ["2023-12-31", "2024-02-29"]
    stamp = df.select(receive_stamp().alias("ts")).first()["ts"]
    assert stamp > T0
    observed, obs = sinks.batch_count(df)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["count"] == 2
    assert alerts.preview(spark.range(500), 100).count() == 100
    msgs = spark.createDataFrame([(bytearray(b'{"a":1}'),)], "value binary")
    assert ingest.values(msgs).first()["value"] == '{"a":1}'
