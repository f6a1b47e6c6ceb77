"""One read of a topic for all of an app's outputs (STR8), and late rows kept (STR5)."""

import json
import os

import pytest

from shoplens.schemas import EVENT_LOG, ORDER_INFO, STARTUP_LOG
from shoplens.sources.ingest import parse_records
from shoplens.streaming import apps, intake, jobs

ONCE = "availableNow"
HOUR = 3_600_000
T0 = 1_704_100_000_000


def put(spark, path, found):
    lines = [x if isinstance(x, str) else json.dumps(x) for x in found]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def run(spark, *argv):
    import argparse
    a = argparse.Namespace(source2=None, users=None, database="shop", checkpoint=None, dau_form="table", user_form="table", salt_buckets=2, panes=False, event_lists=False)
    vars(a).update(dict(zip(argv[::2], argv[1::2])))
    queries = apps.start(spark, a, ONCE)
    for q in queries:
        q.awaitTermination()
    return queries


def log(mid, ts):
    return {"mid": mid, "uid": "u", "type": "startup", "ts": ts}


def event(mid, uid, ts, evid="coupon"):
    return {"mid": mid, "uid": uid, "itemid": "i", "evid": evid, "type": "event", "ts": ts}


@pytest.mark.parametrize("app,good,bad", [
    ("gmv", {"id": "1", "create_time": "2024-01-01 10:00:00", "total_amount": "1"}, '{"id'),
    ("dau", log("m", T0), '{"mid": "m", "ts": "soon"}'),
    ("alert", event("m", "u", T0), "[]"),
    ("route_logs", log("m", T0) | {"more": "x"}, ""),
    ("archive_logs", log("m", T0), "{"),
    ("user_info", {"id": "1", "login_name": "a", "seq": 1}, "{"),
])
def test_an_app_reads_its_source_once(spark, scratch, app, good, bad):
    put(spark, f"{scratch}/src", [good, bad, good])
    queries = run(spark, "app", app, "source", f"{scratch}/src", "out", f"{scratch}/out")
    readers = [p for q in queries for p in q.recentProgress for s in p["sources"] if f"{scratch}/src" in s["description"]]
    assert sum(p["numInputRows"] for p in readers) == 3
    assert len({p["name"] for p in readers}) == 1
    assert [r.raw for r in spark.read.parquet(f"{scratch}/out.rejected").collect()] == [bad]


def test_late_logs_of_the_stateful_dau_are_kept(spark, scratch):
    args = ("app", "dau", "source", f"{scratch}/src", "out", f"{scratch}/out", "dau_form", "state")
    put(spark, f"{scratch}/src", [log("a", T0), log("b", T0 + 60 * HOUR)])
    run(spark, *args)
    put(spark, f"{scratch}/src", [log("late", T0), log("edge", T0 + 36 * HOUR), log("on time", T0 + 36 * HOUR + 1), log("c", T0 + 61 * HOUR), log("c", T0 + 61 * HOUR)])
    queries = run(spark, *args)
    assert sorted(r.mid for r in spark.read.parquet(f"{scratch}/out.late").collect()) == ["edge", "late"]
    assert sorted(r.mid for r in spark.read.parquet(f"{scratch}/out").collect()) == ["a", "b", "c", "on time"]
    assert sum(jobs.dropped_by_watermark(q) for q in queries) == 0


def test_late_events_of_the_alert_are_kept(spark, scratch):
    args = ("app", "alert", "source", f"{scratch}/src", "out", f"{scratch}/out")
    base = T0 - T0 % 5000
    put(spark, f"{scratch}/src", [event("m", f"u{i}", base + i) for i in range(3)] + [event("x", "u", base + 400_000)])
    run(spark, *args)
    last_use = base + 400_000 - 10_000 - 300_000  # a pane from here on is in a window that is still open
    put(spark, f"{scratch}/src", [event("late", "u", last_use - 1), event("late", "u", last_use), event("open", "u", last_use + 5000)])
    queries = run(spark, *args)
    put(spark, f"{scratch}/src", [event("x", "u", base + 2_000_000)])
    queries += run(spark, *args)
    assert sorted((r.mid, r.ts) for r in spark.read.parquet(f"{scratch}/out.late").collect()) == [("late", last_use - 1), ("late", last_use)]
    assert {r.mid for r in spark.read.parquet(f"{scratch}/out").collect()} == {"m"}
    assert sum(jobs.dropped_by_watermark(q) for q in queries) == 0


def test_late_orders_and_lines_are_kept(spark, scratch):
    args = ("app", "sale_detail", "source", f"{scratch}/o", "source2", f"{scratch}/d", "out", f"{scratch}/out")
    order = lambda i, t: {"id": i, "create_time": f"2024-01-01 {t}"}
    line = lambda i, t: {"id": f"d{i}", "order_id": i, "order_price": "1", "detail_time": f"2024-01-01 {t}"}
    put(spark, f"{scratch}/o", [order("1", "10:00:00"), order("2", "11:00:00")])
    put(spark, f"{scratch}/d", [line("1", "10:00:30"), line("2", "11:00:00")])
    run(spark, *args)
    put(spark, f"{scratch}/o", [order("3", "10:10:00"), order("4", "10:59:00")])
    put(spark, f"{scratch}/d", [line("3", "10:10:10"), line("4", "10:59:10"), "no line"])
    queries = run(spark, *args)
    assert [r.id for r in spark.read.parquet(f"{scratch}/out.late").collect()] == ["3"]
    assert [r.id for r in spark.read.parquet(f"{scratch}/out.lines.late").collect()] == ["d3"]
    assert [r.raw for r in spark.read.parquet(f"{scratch}/out.lines.rejected").collect()] == ["no line"]
    assert sorted(r.order_id for r in spark.read.parquet(f"{scratch}/out").collect()) == ["1", "2", "4"]
    assert sum(jobs.dropped_by_watermark(q) for q in queries) == 0


def test_order_pairs_as_an_app(spark, scratch):
    """JOI1 live from its topics: pairs, and rows that met nothing once the watermark is past them; late rows are kept."""
    args = ("app", "order_pairs", "source", f"{scratch}/o", "source2", f"{scratch}/d", "out", f"{scratch}/out")
    order = lambda i, t: {"id": i, "create_time": f"2024-01-01 {t}"}
    line = lambda i, t: {"id": f"d{i}", "order_id": i, "detail_time": f"2024-01-01 {t}"}
    put(spark, f"{scratch}/o", [order("1", "10:00:00"), order("2", "10:00:00")])
    put(spark, f"{scratch}/d", [line("1", "10:00:30"), line("9", "10:00:00"), "no line"])
    queries = run(spark, *args)
    put(spark, f"{scratch}/o", [order("z", "12:00:00")])
    put(spark, f"{scratch}/d", [line("z", "12:00:00")])
    queries += run(spark, *args)
    put(spark, f"{scratch}/o", [order("late", "10:00:00")])
    put(spark, f"{scratch}/d", [line("y", "12:30:00")])
    queries += run(spark, *args)
    got = {(r.order_id, r.order_detail_id, r.match_state) for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert {g for g in got if g[0] in "129"} == {("1", "d1", "both"), ("2", None, "order_only"), ("9", "d9", "detail_only")}
    assert ("z", "dz", "both") in got
    assert [r.id for r in spark.read.parquet(f"{scratch}/out.late").collect()] == ["late"]
    assert [r.raw for r in spark.read.parquet(f"{scratch}/out.lines.rejected").collect()] == ["no line"]
    assert sum(jobs.dropped_by_watermark(q) for q in queries) == 0


def test_alert_documents_with_event_lists(spark, scratch):
    args = ("app", "alert", "source", f"{scratch}/src", "out", f"{scratch}/out", "event_lists", True)
    base = T0 - T0 % 5000
    put(spark, f"{scratch}/src", [event("m", f"u{i}", base + i) for i in range(3)] + [event("m", "u0", base + 9, "share")] * 2)
    run(spark, *args)
    put(spark, f"{scratch}/src", [event("x", "u", base + 2_000_000)])
    run(spark, *args)
    found = spark.read.parquet(f"{scratch}/out").where("mid = 'm'")
    assert dict(found.dtypes)["events"] == "array<string>"
    assert {tuple(sorted(r.events)) for r in found.collect()} == {("coupon",) * 3 + ("share",) * 2}


def test_a_second_topic_is_asked_for(capsys):
    with pytest.raises(SystemExit):
        apps.main(["order_pairs", "--source", "/nowhere", "--out", "/nowhere/out"])
    assert "--source2" in capsys.readouterr().err


def test_a_batch_that_is_tried_again_changes_nothing(spark, scratch):
    def batch(*found):
        return parse_records(spark.createDataFrame([(json.dumps(x),) for x in found], "value string"), STARTUP_LOG)

    path, late = f"{scratch}/t", intake.log_lateness("1 hour")
    os.makedirs(f"{path}/_staged/batch=0/kind=good")  # what a first try left behind
    spark.createDataFrame([("ghost",)], "mid string").write.mode("overwrite").parquet(f"{path}/_staged/batch=0/kind=good")
    intake.store_batch(batch(log("a", T0), log("b", T0 + 2 * HOUR)), path, 0, late)
    intake.store_batch(batch(log("other", T0)), path, 0, late)
    intake.store_batch(batch(), path, 1, late)  # an empty batch hands the mark on
    intake.store_batch(batch(log("c", T0 + HOUR), log("d", T0 + HOUR + 1), {"mid": "no time"}), path, 2, late)
    kinds = {}
    for n in (0, 2):
        for kind in ("good", "late"):
            if os.path.isdir(f"{path}/batch={n}/kind={kind}"):
                kinds[n, kind] = sorted(r.mid for r in spark.read.parquet(f"{path}/batch={n}/kind={kind}").collect())
    assert kinds == {(0, "good"): ["a", "b"], (2, "good"): ["d", "no time"], (2, "late"): ["c"]}


def test_schemas_of_intakes(spark, scratch):
    for schema, kind in ((ORDER_INFO, "good"), (EVENT_LOG, "late")):
        assert intake.records(spark, f"{scratch}/none", schema, kind, ("offset",)).columns == [*schema.names, "offset"]
    assert intake.records(spark, f"{scratch}/none", ORDER_INFO, "rejected").columns == ["raw"]
