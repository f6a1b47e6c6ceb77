"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Batch queries run end to end from the test tables (staging included) into Spark's ``noop`` sink, so every row is
computed and nothing is collected.  Streaming jobs run with ``availableNow`` and no rate limit (a back-fill of
the whole topic) over JSON-lines topic folders that are staged once before timing; multi-batch behaviour (state
carried across micro-batches, watermarks) is covered by tests/test_streaming.py.  The join stream reads two files
per micro-batch: its state is evicted by the watermark between batches, so one huge batch would hold both whole
inputs in state at once.  Each query: one warm-up, then the median of ``BENCH_RUNS`` (default 3).
Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["dau_hours", "dau_compare_hours", "gmv_hours", "kpi_total", "coupon_alert", "coupon_alert_naive",
            "sale_detail", "sale_detail_user", "sale_search_page", "route_changes", "latest_documents"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    os.environ["BENCH_CPUS"] = cpus

    import pyspark
    from pyspark.sql import functions as F

    from shoplens.plans.queries import QUERIES
    from shoplens.session import build_session, checkpoint_path
    from shoplens.sources import staging
    from shoplens.sources.ingest import file_stream
    from shoplens.sources.tables import Tables
    from shoplens.streaming import jobs

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # staged topics and stream checkpoints live in the shared checkpoint folder the session names (a fresh one per run)
    scratch = checkpoint_path(spark, f"bench-{uuid.uuid4().hex}")

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    def median_of(fn) -> float:
        fn()  # warm-up
        return statistics.median(timed(fn) for _ in range(runs))

    results: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        q = QUERIES[name]
        results[name] = round(median_of(lambda: q(spark, sf_dir).write.format("noop").mode("overwrite").save()), 3)
        rows[name] = q(spark, sf_dir).count()

    # ---- streams: stage topic folders once (not timed), then run each job to the end with availableNow
    t = Tables(spark, sf_dir)

    def stage(df, name: str, time_expr, n: int = 8) -> str:
        path = os.path.join(scratch, "topics", name)
        js = df.select(time_expr.cast("double").alias("_t"), F.to_json(F.struct(*df.columns)).alias("value"))
        js.repartitionByRange(n, "_t").sortWithinPartitions("_t").select("value").write.text(path)
        return path

    def ts_of(c):
        return F.unix_timestamp(F.to_timestamp(c, "yyyy-MM-dd HH:mm:ss"))

    start_src = stage(staging.startup(t), "start", F.col("ts"))
    event_src = stage(staging.event_log(t), "event", F.col("ts"))
    order_src = stage(staging.order_info(t), "order_info", ts_of(F.col("create_time")))
    detail_src = stage(staging.order_detail(t), "order_detail", ts_of(F.col("detail_time")))
    counter = iter(range(10_000))

    def run_stream(build, sink: str) -> int:
        k = next(counter)
        ck = os.path.join(scratch, "ck", str(k))
        out = os.path.join(scratch, "out", str(k))
        df = build()
        if sink == "docs":
            q = jobs.start_document_sink(df, out, f"bench_{k}", trigger="availableNow", checkpoint=ck)
        else:
            q = jobs.start_file_sink(df, out, f"bench_{k}", trigger="availableNow", checkpoint=ck)
        jobs.run_to_end(q)
        return jobs.input_rows(q)

    streams = {
        "stream_dau": (lambda: jobs.dau_first_seen(file_stream(spark, start_src)), "files"),
        "stream_sale_detail": (lambda: jobs.sale_detail_stream(file_stream(spark, order_src, 2),
                                                                file_stream(spark, detail_src, 2),
                                                                100, "10 minutes"), "files"),
        "stream_alert": (lambda: jobs.alert_stream(file_stream(spark, event_src)), "docs"),
    }
    for name, (build, sink) in streams.items():
        results[name] = round(median_of(lambda: run_stream(build, sink)), 3)

    total = round(sum(results.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": total,
        "unit": "sec",
        "queries": results,
        "rows": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "spark": pyspark.__version__,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
