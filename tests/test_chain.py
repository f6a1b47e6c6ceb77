"""The jobs chained as in service: change log → routing → topics → jobs; restarts; malformed records."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplens import sinks
from shoplens.functions import columns as C
from shoplens.operators import dashboard, gmv, routing, sales
from shoplens.operators.dims import latest_users, version_order
from shoplens.plans.queries import QUERIES
from shoplens.sinks import keyed_table, runs
from shoplens.schemas import (COUPON_ALERT, EVENT_LOG, ORDER_INFO, RAW_LOG, STARTUP_LOG, TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO,
                              TOPIC_USER_INFO, USER_INFO)
from shoplens.sources import staging
from shoplens.sources.ingest import file_stream, good_records, message_stream, parse_records, quarantine
from shoplens.sources.tables import Tables
from shoplens.streaming import apps, jobs

ONCE = "availableNow"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def topics(spark, tmp_path_factory):
    """Topic folders, as ``route_changes_app`` writes them from the change log's messages."""
    root = str(tmp_path_factory.mktemp("chain"))
    changes = staging.change_log(Tables(spark, SF_SMALL), arrival=True)
    body = [c for c in changes.columns if c not in ("timestamp", "partition", "offset")]
    messages = changes.select(F.to_json(F.struct(*body)).alias("value"), "timestamp", "partition", "offset")
    messages.orderBy("timestamp").coalesce(2).write.parquet(f"{root}/changes")
    jobs.run_to_end(apps.route_changes_app(spark, f"messages:{root}/changes", f"{root}/topics", "shop", ONCE))
    return root


def test_orders_reach_the_gmv_table(spark, topics):
    out = f"{topics}/orders"
    jobs.run_to_end(apps.gmv_app(spark, f"messages:{topics}/topics/topic={TOPIC_ORDER_INFO}", out, ONCE))
    table = spark.read.parquet(out)
    routed = routing.route_changes(staging.change_log(Tables(spark, SF_SMALL)), "shop").where(F.col("topic") == TOPIC_ORDER_INFO)
    assert table.count() == routed.count() > 0
    assert table.where("TOTAL_AMOUNT IS NULL").count() == 0
    day = table.select("CREATE_DATE").first()[0]
    want = gmv.gmv_hours(gmv.clean_orders(good_records(parse_records(routed, ORDER_INFO))), str(day))
    got = table.where(F.col("CREATE_DATE") == F.lit(day)).groupBy("CREATE_HOUR").agg(F.sum(C.money("TOTAL_AMOUNT")).cast("double").alias("gmv"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lines_meet_orders_by_arrival_time(spark, topics):
    out = f"{topics}/sale_detail"
    q = apps.sale_detail_app(spark, f"messages:{topics}/topics/topic={TOPIC_ORDER_INFO}", f"messages:{topics}/topics/topic={TOPIC_ORDER_DETAIL}", out, trigger=ONCE)
    jobs.run_to_end(q)
    want = QUERIES["chain_sale_detail"](spark, SF_SMALL)
    got = spark.read.parquet(out).withColumn("dt", F.col("dt").cast("string")).select(*want.columns)
    assert rows(got) == rows(want) and want.count() > 0


def test_users_take_their_order_from_their_messages(spark, topics):
    """Versions of one user stand in both partitions of the change log: times order them, not offsets."""
    src, want = f"messages:{topics}/topics/topic={TOPIC_USER_INFO}", QUERIES["chain_user_latest"](spark, SF_SMALL)
    named = lambda users: users.select("id", "login_name", "user_level", "birthday", "gender", F.unix_seconds("timestamp").alias("seq"))
    jobs.run_to_end(apps.user_info_app(spark, src, f"{topics}/user_log", ONCE, form="log"))
    versions = spark.read.parquet(f"{topics}/user_log")
    assert rows(named(latest_users(versions))) == rows(want)
    by_offset = versions.groupBy("id").agg(F.max_by("user_level", "offset").alias("user_level"))
    assert rows(by_offset) != rows(want.select("id", "user_level"))
    jobs.run_to_end(apps.user_info_app(spark, src, f"{topics}/users", ONCE))
    schema = keyed_table.with_arrival(USER_INFO)
    assert rows(named(keyed_table.read_keyed(spark, f"{topics}/users", schema, ("id",), version_order(schema.names)))) == rows(want)


def test_a_late_version_of_another_partition_does_not_win(spark):
    msgs = spark.createDataFrame([('{"id": "1", "user_level": "1"}', "2024-01-01 00:00:00", 0, 900), ('{"id": "1", "user_level": "2"}', "2024-01-02 00:00:00", 1, 3)],
                                 "value string, timestamp string, partition int, offset long").withColumn("timestamp", F.to_timestamp("timestamp"))
    assert [r.user_level for r in latest_users(jobs.user_changes(msgs)).collect()] == ["2"]


def test_topic_messages_have_the_row_as_key(spark):
    changes = staging.change_log(Tables(spark, SF_SMALL))
    out = sinks.topic_messages(routing.route_changes(changes, "shop"))
    assert out.columns == ["topic", "key", "value"] and out.where("key <> get_json_object(value, '$.id')").count() == 0
    assert sinks.topic_messages(spark.createDataFrame([("t", "v")], "topic string, value string")).columns == ["topic", "value"]


# ---- merged runs: the seen set, first days and roll-ups ------------------------------------------------------------

def test_runs_stay_few_over_many_batches():
    """A group's runs are bounded by the fan-out times the levels, and a batch's rows are rewritten once a level."""
    runs_, held, rewritten = [], {}, {}
    for batch in range(1000):
        runs_, due = runs.planned(runs_, batch, 8)
        held[batch] = {batch}.union(*(held.pop(n) for n in due))
        for n in held[batch]:
            rewritten[n] = rewritten.get(n, 0) + 1
        assert [r[0] for r in runs_] == sorted(held) and sum(map(len, held.values())) == batch + 1
        assert len(runs_) <= 7 * 4
    assert max(rewritten.values()) <= 4


def test_runs_against_a_sum(spark, scratch):
    import random
    from collections import Counter

    r, want, path = random.Random(4), Counter(), f"{scratch}/t"
    schema = "grp string, k string, n long"
    for batch in range(11):
        made = [(f"2024-0{r.randrange(1, 4)}", r.choice("abc"), r.randrange(9)) for _ in range(r.randrange(0, 8))]
        rows_ = spark.createDataFrame(made, schema)
        for _ in range(2 if batch % 5 == 3 else 1):  # some batches are written again
            runs.append_run(rows_, path, batch, runs.summed("k"), fanout=3)
        for g, k, n in made:
            want[g, k] += n
    got = Counter()
    for x in runs.read_runs(spark, path, "k string, n long").collect():
        got[x.grp, x.k] += x.n
    assert got == want
    one = runs.read_runs(spark, path, "k string, n long", ["2024-02", "1999-01"])
    assert {f.split("grp=")[1].split("/")[0] for f in one.inputFiles()} == {"2024-02"} and len(one.inputFiles()) <= 3 * 3
    assert {x.grp for x in one.collect()} == {"2024-02"}
    assert runs.read_runs(spark, f"{scratch}/none", "k string").count() == 0


def _day(n):
    return 1_704_067_200_000 + n * 86_400_000


def test_dau_batches_keep_first_days_and_hours(spark, scratch):
    """Late logs move a first day back; replays change nothing; logs without a time or device are stored once."""
    from shoplens.operators import publisher

    batches = [[("a", 1), ("b", 1), ("b", 1), (None, 1)], [("a", 2), ("c", 2), ("b", 0)], [("a", 0), ("d", 2), ("x", None), (None, 1)], [("x", None), ("c", 2)]]
    path = f"{scratch}/dau"
    logs = lambda found: dau.with_log_time(spark.createDataFrame([dict(mid=m, uid="1", type="startup", ts=None if d is None else _day(d) + i) for i, (m, d) in enumerate(found)], STARTUP_LOG))
    from shoplens.operators import dau

    for n, found in enumerate(batches):
        for _ in range(2 if n in (1, 2) else 1):
            jobs.store_dau_batch(logs(found), path, n)
    everything = logs([x for b in batches for x in b])
    table = spark.read.parquet(path).select("mid", F.col("logdate").cast("string"))
    assert rows(table) == rows(everything.select("mid", "logdate").distinct())
    per_day = everything.where("mid IS NOT NULL AND logdate IS NOT NULL").groupBy("mid").agg(F.min("logdate").alias("d"))
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        got = {r.id: r.value for r in publisher.rollup_total(spark, path, f"{scratch}/orders", day).collect()}
        assert got == {"dau": everything.where(F.col("logdate") == day).select("mid").distinct().count(), "new_mid": per_day.where(F.col("d") == day).count(), "order_amount": None}
    hours = {r.hour: (r.today, r.yesterday) for r in publisher.rollup_hours(spark, path, "", "dau", "2024-01-03").collect()}
    assert hours["00"] == (3, 3) and len(hours) == 24


def test_a_dau_table_without_a_seen_set_gets_one(spark, scratch):
    from shoplens.operators import dau, publisher

    path = f"{scratch}/dau"
    logs = lambda *found: dau.with_log_time(spark.createDataFrame([dict(mid=m, uid="1", type="startup", ts=_day(d)) for m, d in found], STARTUP_LOG))
    sinks.write_dau_batch(dau.daily_active(logs(("a", 0), ("b", 0))), path, 0)
    jobs.store_dau_batch(logs(("a", 0), ("c", 0), ("a", 1)), path, 1)
    assert rows(spark.read.parquet(path).select("mid", F.col("logdate").cast("string"))) == rows(logs(("a", 0), ("b", 0), ("c", 0), ("a", 1)).select("mid", "logdate"))
    assert {r.id: r.value for r in publisher.rollup_total(spark, path, f"{scratch}/o", "2024-01-01").collect()}["new_mid"] == 3


def test_the_order_job_keeps_amounts(spark, topics, scratch):
    from shoplens.operators import publisher

    out = f"{scratch}/orders"
    jobs.run_to_end(apps.gmv_app(spark, f"messages:{topics}/topics/topic={TOPIC_ORDER_INFO}", out, ONCE))
    orders = spark.read.parquet(out).withColumn("CREATE_DATE", F.col("CREATE_DATE").cast("string")).toDF(*[c.lower() for c in spark.read.parquet(out).columns])
    day = orders.select("create_date").first()[0]
    want = dashboard.compare_hours(orders, day, "create_date", "create_hour", F.col("total_amount"), "double")
    assert rows(publisher.rollup_hours(spark, "", out, "order_amount", day)) == rows(want)


# ---- the bucketed user table --------------------------------------------------------------------------------------

VERSIONS = "id string, v long, n long"


def versions(spark, *found):
    return spark.createDataFrame([(i, v, n) for i, v, n in found], VERSIONS)


def latest(spark, path):
    return {r.id: r.v for r in keyed_table.read_keyed(spark, path, versions(spark).schema, ("id",), ("n",)).collect()}


def test_keyed_table_against_a_dictionary(spark, scratch):
    import random

    r, path, want = random.Random(3), f"{scratch}/t", {}
    for batch in range(12):
        made = [(f"u{r.randrange(40)}", r.randrange(1000), batch * 100 + i) for i in range(r.randrange(0, 15))]
        rows_ = versions(spark, *made)
        keyed_table.write_keyed(rows_, path, batch, ("id",), ("n",), n_buckets=5, merge_at=3)
        if batch % 4 == 0:  # a replayed batch changes nothing
            keyed_table.write_keyed(rows_, path, batch, ("id",), ("n",), n_buckets=5, merge_at=3)
        want |= {i: v for i, v, _ in made}
        if batch % 3 == 2:
            assert latest(spark, path) == want
    now, _ = keyed_table.head(spark, path)
    assert now["batch"] == 11 and all(1 <= len(b) < 3 for b in now["buckets"].values())


def test_keyed_table_reads_only_the_buckets_asked_for(spark, scratch):
    path = f"{scratch}/t"
    keyed_table.write_keyed(versions(spark, *((f"u{i}", i, 1) for i in range(200))), path, 0, ("id",), ("n",), n_buckets=16)
    one = versions(spark, ("u7", 70, 2))
    keyed_table.write_keyed(one, path, 1, ("id",), ("n",))
    bucket = one.select(keyed_table.bucket_of(["id"], 16).alias("b")).first().b
    now, _ = keyed_table.head(spark, path)
    assert now["buckets"][str(bucket)] == [0, 1] and all(b == [0] for k, b in now["buckets"].items() if k != str(bucket))
    found = keyed_table.lookup(one.select("id"), path, one.schema, ("id",), ("n",))
    assert {f.split("bucket=")[1].split("/")[0] for f in keyed_table._stored(spark, path, one.schema, now["buckets"], [bucket]).inputFiles()} == {str(bucket)}
    assert {f.split("/bucket=")[1].split("/")[0] for f in found.inputFiles() if "/bucket=" in f} == {str(bucket)}
    assert [tuple(r) for r in found.collect()] == [("u7", 70, 2)]


def test_a_write_that_died_leaves_the_table_as_it_was(spark, scratch):
    path = f"{scratch}/t"
    keyed_table.write_keyed(versions(spark, ("a", 1, 1), ("b", 1, 1)), path, 0, ("id",), ("n",), n_buckets=2)
    # batch 1 stored its rows, but not the head
    versions(spark, ("a", 2, 2)).withColumn("bucket", keyed_table.bucket_of(["id"], 2)).withColumn("batch", F.lit(1)).write.mode("append").partitionBy("batch", "bucket").parquet(f"{path}/data")
    assert latest(spark, path) == {"a": 1, "b": 1}
    keyed_table.write_keyed(versions(spark, ("a", 3, 2)), path, 1, ("id",), ("n",))
    assert latest(spark, path) == {"a": 3, "b": 1}


def test_enrichment_without_a_user_table(spark, scratch):
    """Before the table is there, sales have no user; then its buckets are looked up."""
    sale = spark.createDataFrame([("1",), ("2",), (None,)], "user_id string")
    assert jobs.users_of(sale, f"{scratch}/users").count() == 0
    spark.createDataFrame([('{"id": "1", "user_level": "3"}',), ('{"id": "9", "user_level": "4"}',)], "value string").write.text(f"{scratch}/src")
    jobs.run_to_end(apps.user_info_app(spark, f"{scratch}/src", f"{scratch}/users", ONCE))
    assert [(r.id, r.user_level) for r in jobs.users_of(sale, f"{scratch}/users").collect()] == [("1", "3")]


def test_enrichment_sees_users_that_come_later(spark, scratch):
    orders = [{"id": str(i), "create_time": f"2024-01-01 10:00:0{i}", "user_id": "7", "order_status": "1"} for i in range(2)]
    lines = [{"id": f"d{i}", "order_id": str(i), "sku_name": "x", "order_price": "1.5", "detail_time": f"2024-01-01 10:00:0{i}"} for i in range(2)]
    users = spark.createDataFrame([("7", "a", "1", "1990-01-01", "F", 1)], USER_INFO)
    users.write.parquet(f"{scratch}/users")

    def feed(i):
        for name, found in (("o", orders), ("d", lines)):
            spark.createDataFrame([(json.dumps(found[i]),)], "value string").coalesce(1).write.mode("append").text(f"{scratch}/{name}")

    feed(0)
    run = lambda: jobs.run_to_end(apps.sale_detail_app(spark, f"{scratch}/o", f"{scratch}/d", f"{scratch}/out", f"{scratch}/users", ONCE, salt_buckets=2))
    run()
    spark.createDataFrame([("7", "a", "5", "1990-01-01", "F", 2)], USER_INFO).write.mode("append").parquet(f"{scratch}/users")
    feed(1)
    run()
    got = {r.order_detail_id: r.user_level for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert got == {"d0": "1", "d1": "5"}


def test_restart_with_defaults_goes_on(spark, scratch):
    """The same command again: nothing lost, nothing doubled; another checkpoint is refused."""
    logs = staging.startup(Tables(spark, SF_SMALL))
    js = logs.select(F.to_json(F.struct(*logs.columns)).alias("value"), "ts")
    src, out = f"{scratch}/src", f"{scratch}/dau"
    js.where("ts % 2 = 0").select("value").coalesce(1).write.text(src)
    jobs.run_to_end(apps.dau_app(spark, src, out, ONCE))
    js.where("ts % 2 = 1").select("value").coalesce(1).write.mode("append").text(src)
    jobs.run_to_end(apps.dau_app(spark, src, out, ONCE))
    from shoplens.operators import dau

    got = spark.read.parquet(out).select("mid", F.col("logdate").cast("string"))
    assert rows(got) == rows(dau.daily_active(logs).select("mid", "logdate"))
    for start in (apps.dau_app, lambda *a, **k: apps.dau_app(*a, **k, form="state")):
        with pytest.raises(ValueError, match="belongs to the checkpoint"):
            start(spark, src, out, ONCE, checkpoint=f"{scratch}/other")


def test_a_half_visible_batch_is_written_again(spark, scratch):
    """Of a batch's ten devices, four were stored when the job died: the replay stores all ten."""
    t0 = 1_704_067_200_000
    made = [dict(mid=f"m{i}", uid="1", type="startup", ts=t0 + i) for i in range(10)]
    logs = spark.createDataFrame(made, STARTUP_LOG)
    src, out = f"{scratch}/src", f"{scratch}/dau"
    logs.select(F.to_json(F.struct(*logs.columns)).alias("value")).coalesce(1).write.text(src)
    from shoplens.operators import dau

    sinks.write_dau_batch(dau.daily_active(logs.where("ts < %d" % (t0 + 4))), out, 0)
    jobs.run_to_end(apps.dau_app(spark, src, out, ONCE))
    assert spark.read.parquet(out).count() == 10


def test_forms_of_the_dau_job_do_not_mix(spark, scratch):
    logs = spark.createDataFrame([dict(mid="m", uid="1", type="startup", ts=1_704_067_200_000)], STARTUP_LOG)
    from shoplens.operators import dau

    sinks.write_dau_table(dau.daily_active(logs), f"{scratch}/dau")
    with pytest.raises(ValueError, match="another form"):
        jobs.store_dau_batch(dau.with_log_time(logs), f"{scratch}/dau", 0)


def test_short_delays_are_refused(spark, scratch):
    os.makedirs(f"{scratch}/src")
    with pytest.raises(ValueError, match="a day or more"):
        jobs.dau_first_seen(file_stream(spark, f"{scratch}/src"), delay="1 hour")


def test_apps_keep_the_submitted_session(spark, scratch, monkeypatch):
    """``main`` sets no master, memory or partitions, and keeps malformed records."""
    from pyspark.sql import SparkSession

    asked = []
    monkeypatch.setattr(type(SparkSession.builder), "config", lambda self, *a, **k: asked.append((a, k)) or self)
    monkeypatch.setattr(type(SparkSession.builder), "master", lambda self, *a: asked.append(a) or self)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    good = {"id": "1", "create_time": "2024-01-01 10:00:00", "total_amount": "12.50"}
    lines = [json.dumps(good), '{"id": "2", "total_', json.dumps(good | {"id": "3", "total_amount": "a lot"}), ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/src")
    apps.main(["gmv", "--source", f"{scratch}/src", "--out", f"{scratch}/out", "--once"])
    assert [a for a in asked if a != (("spark.app.name", "shoplens-gmv"), {})] == [] and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/out").select("ID", "TOTAL_AMOUNT").collect()] == [("1", 12.5)]
    assert sorted(r.raw for r in spark.read.parquet(f"{scratch}/out.rejected").collect()) == sorted(lines[1:])


def test_split_sink_writes_both_outputs(spark, scratch):
    spark.createDataFrame([('{"id": "1", "seq": 2}',), ("{",), ('{"id": "2", "seq": "x"}',)], "value string").coalesce(1).write.text(f"{scratch}/src")
    for _ in range(2):
        q = jobs.start_split_sink(file_stream(spark, f"{scratch}/src"), USER_INFO, lambda df: df.select("id", "seq"), f"{scratch}/out", f"{scratch}/bad", "split", ONCE)
        jobs.run_to_end(q)
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/out").select("id", "seq").collect()] == [("1", 2)]
    assert sorted(r.raw for r in spark.read.parquet(f"{scratch}/bad").collect()) == sorted(['{"id": "2", "seq": "x"}', "{"])


def test_malformed_values_give_nulls(spark):
    df = spark.createDataFrame([("2020-12-07", "n/a", "x1", "n.5")], "create_time string, birthday string, price string, num string")
    got = df.select(C.text_to_timestamp("create_time"), C.age_years("birthday", F.to_date(F.lit("2026-01-01"))), C.money("price")).first()
    assert tuple(got) == (None, None, None)
    orders = spark.createDataFrame([("1", "2020-12-07", "u", "s")], "id string, create_time string, user_id string, order_status string")
    lines = spark.createDataFrame([("d", "1", "sku", "name", "cheap", "many", "noon")], "id string, order_id string, sku_id string, sku_name string, order_price string, sku_num string, detail_time string")
    assert sales.sale_details(orders, lines).count() == 0
    assert sales.sale_details_all(orders, lines).first().sku_price is None
    assert dashboard.product_top(lines).first().num is None
    twice = spark.createDataFrame([([("id", "1"), ("a", "x"), ("a", "y"), (None, "z")],)], "after array<struct<name:string,value:string>>")
    assert json.loads(twice.select(C.after_image_json()).first()[0]) == {"id": "1", "a": "y"}


def test_numbers_as_text_and_misfits(spark):
    msgs = spark.createDataFrame([('{"id": "1", "total_amount": "10.5"}',), ('{"id": 2, "total_amount": 3}',), ('{"id": "3", "total_amount": "ten"}',),
                                  ("[]",), (None,), ("",)], "value string")
    records = parse_records(msgs, ORDER_INFO)
    assert sorted((r.id, r.total_amount) for r in good_records(records).collect() if r.id) == [("1", 10.5), ("2", 3.0)]
    assert '{"id": "3", "total_amount": "ten"}' in {r.raw for r in quarantine(records).collect()}


def test_unknown_log_fields_survive(spark, scratch):
    line = {"type": "event", "mid": "m", "evid": "share", "ts": 1_704_067_200_000, "new_field": "kept", "deep": {"a": 1}}
    spark.createDataFrame([(json.dumps(line),)], "value string").write.text(f"{scratch}/src")
    jobs.run_to_end(apps.route_logs_app(spark, f"{scratch}/src", f"{scratch}/topics", ONCE))
    got = json.loads(spark.read.text(f"{scratch}/topics").first().value)
    assert got["new_field"] == "kept" and json.loads(got["deep"]) == {"a": 1} and got["ts"] > line["ts"]
    jobs.run_to_end(apps.archive_logs_app(spark, f"{scratch}/src", f"{scratch}/archive", ONCE))
    kept = spark.read.text(f"{scratch}/archive").first()
    assert json.loads(kept.value)["new_field"] == "kept" and str(kept.dt) == "2024-01-01"
    records = parse_records(spark.read.text(f"{scratch}/src"), RAW_LOG, extra="more")
    assert records.first().more["new_field"] == "kept"


def test_any_event_id_is_listed(spark):
    from shoplens.operators import alerts

    t0 = 1_704_067_200_000
    made = [dict(mid="m", uid=str(i), evid="coupon", itemid=str(i), ts=t0 + i) for i in range(3)] + [dict(mid="m", uid="9", evid="share", ts=t0 + 9)] * 2
    ev = spark.createDataFrame(made, EVENT_LOG)
    forms = [alerts.coupon_alerts(ev, **how) for how in ({}, {"panes": True}, {"two_phase": True}, {"prefilter": False})]
    for df in forms:
        assert {(r.n_events, r.events) for r in df.collect()} == {(5, "coupon:3,share:2")}
    out = alerts.records(forms[0])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [(f.name, f.dataType.simpleString()) for f in COUPON_ALERT]
    assert sorted(out.first().events) == ["coupon"] * 3 + ["share"] * 2


def test_documents_of_two_indexes(spark, scratch):
    docs = spark.createDataFrame([("a", "i1", 1), ("a", "i2", 2)], "doc_id string, index_name string, v long")
    sinks.upsert_documents(docs, f"{scratch}/docs", 0)
    sinks.upsert_documents(docs.where("v = 2").withColumn("v", F.lit(3)), f"{scratch}/docs", 1)
    assert sorted((r.index_name, r.v) for r in sinks.latest_documents(spark, f"{scratch}/docs").collect()) == [("i1", 1), ("i2", 3)]


def test_full_outer_pairs_as_a_stream(spark, scratch):
    orders = [{"id": str(i), "create_time": f"2024-01-01 1{i}:00:00"} for i in range(3)]
    lines = [{"id": "d0", "order_id": "0", "detail_time": "2024-01-01 10:00:30"}, {"id": "d1", "order_id": "1", "detail_time": "2024-01-01 11:30:00"},
             {"id": "d9", "order_id": "9", "detail_time": "2024-01-01 10:10:00"}]
    late = "2024-01-03 00:00:00"
    for name, found in (("o", orders), ("d", lines)):
        spark.createDataFrame([(json.dumps(x),) for x in found], "value string").coalesce(1).write.text(f"{scratch}/{name}")
    out = jobs.order_pairs_stream(file_stream(spark, f"{scratch}/o", 1), file_stream(spark, f"{scratch}/d", 1))
    run = lambda: jobs.run_to_end(jobs.start_file_sink(out, f"{scratch}/out", "pairs", trigger=ONCE))
    run()
    spark.createDataFrame([(json.dumps({"id": "z", "create_time": late}),)], "value string").coalesce(1).write.mode("append").text(f"{scratch}/o")
    spark.createDataFrame([(json.dumps({"id": "dz", "order_id": "z", "detail_time": late}),)], "value string").coalesce(1).write.mode("append").text(f"{scratch}/d")
    run()
    got = {(r.order_id, r.order_detail_id, r.match_state) for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert {g for g in got if g[0] != "z"} == {("0", "d0", "both"), ("1", None, "order_only"), ("1", "d1", "detail_only"), ("2", None, "order_only"), ("9", "d9", "detail_only")}


def test_topic_sink_options():
    assert jobs.topic_options("host:1", "/shared/ck") == {"kafka.bootstrap.servers": "host:1", "checkpointLocation": "/shared/ck"}


def test_checkpoint_folder_is_required_on_a_cluster(spark):
    from shoplens import session

    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_message_stream_has_a_topics_columns(spark, scratch):
    os.makedirs(f"{scratch}/m")
    assert message_stream(spark, f"{scratch}/m").columns == ["value", "timestamp", "partition", "offset"]
    assert set(apps.SOURCE_SCHEMA) == set(apps.APPS)


def test_pages_by_key_equal_pages_by_offset(spark):
    hits = spark.createDataFrame([(f"2024-01-0{1 + i % 3}", f"d{i:02}") for i in range(17)], "dt string, order_detail_id string")
    seen, after = [], None
    while page := dashboard.page_after(hits, after, 5).collect():
        seen += [tuple(r) for r in page]
        after = tuple(page[-1])
    assert seen == sorted(tuple(r) for r in hits.collect())
    assert [tuple(r)[:2] for r in dashboard.page(hits, 5, 5).collect()] == seen[5:10]
