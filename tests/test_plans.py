"""Physical-plan checks for every registered query: no pair explosions, no Python in the plan, pushed filters and
pruned columns where the query allows them."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplens.plans.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    # scan metadata (pushed filters, read schema) is abbreviated beyond this length in plan text
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_explosion_or_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def _scan_lines(plan: str, table: str) -> list[str]:
    return [ln for ln in plan.split("\n") if "FileScan" in ln and f"{table}.parquet" in ln]


@pytest.mark.parametrize("name,table,column", [
    ("dau_hours", "events", "ts"), ("dau_total", "events", "ts"), ("dau_compare_hours", "events", "ts"),
    ("gmv_hours", "orders", "o_orderdate"), ("gmv_total", "orders", "o_orderdate"),
])
def test_day_filter_reaches_the_scan(spark, name, table, column):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    scans = _scan_lines(plan, table)
    assert scans
    for ln in scans:
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln).group(1)
        assert f"GreaterThanOrEqual({column}" in pushed and f"LessThan({column}" in pushed


@pytest.mark.parametrize("name,table,unused", [
    ("sale_detail", "lineitem", ["l_tax", "l_discount", "l_returnflag", "l_shipdate"]),
    ("sale_detail", "orders", ["o_orderpriority"]),
    ("coupon_alert", "events", ["value"]),
    ("dau_first_log", "events", ["value", "props", "event_type"]),
    ("region_sales", "customer", ["c_acctbal", "c_mktsegment", "c_name"]),
])
def test_scans_read_only_needed_columns(spark, name, table, unused):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    scans = _scan_lines(plan, table)
    assert scans
    for ln in scans:
        schema = re.search(r"ReadSchema: struct<([^>]*)>", ln).group(1)
        for col in unused:
            assert f"{col}:" not in schema, f"{name} reads {table}.{col}"


@pytest.mark.parametrize("name,column", [
    ("stored_dau_hours", "logdate"), ("stored_gmv_hours", "CREATE_DATE"), ("stored_kpi_total", "logdate"),
])
def test_stored_tables_prune_to_the_asked_days(spark, name, column):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any(column in f for f in filters), f"{name}: no partition filter on {column}"


def test_full_outer_pairs_avoid_a_full_outer_join(spark):
    # AQE cannot split a skewed key of a full outer join; JOI1 is a left join plus an anti join instead
    plan = _plan(E.queries()["order_detail_pairs"](spark, SF_SMALL))
    assert "FullOuter" not in plan
    assert "LeftAnti" in plan and "LeftOuter" in plan
    # the anti join's detail keys are made distinct map-side first (a hot order id ships one row per task)
    assert re.search(r"HashAggregate\(keys=\[d_order_id[^\]]*\], functions=\[\]", plan)


def test_day_partitioned_writes_rebalance_on_the_day(spark):
    # a day-partitioned write is clustered by its day first (AQE may split a hot day), not one file per day per task
    from shoplens import sinks
    from shoplens.plans import queries as Q
    rows = sinks._by_day(Q._dau_rows(Q._t(spark, SF_SMALL)).select(*sinks.DAU_TABLE_COLUMNS), "logdate")
    plan = _plan(rows)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "hashpartitioning(logdate" in plan


@pytest.mark.parametrize("name", ["dau_hours", "dau_compare_hours", "stored_dau_hours", "dau_total", "kpi_total", "dau_new_devices", "stored_kpi_total"])
def test_hour_questions_use_hash_aggregates(spark, name):
    assert "SortAggregate" not in _plan(E.queries()[name](spark, SF_SMALL))


def test_kpi_reads_the_logs_once(spark):
    assert len(_scan_lines(_plan(E.queries()["kpi_total"](spark, SF_SMALL)), "events")) == 1


@pytest.mark.parametrize("name", ["sale_detail", "order_detail_pairs", "gmv_hours", "kpi_total"])
def test_orders_without_customer_columns_skip_the_join(spark, name):
    assert not _scan_lines(_plan(E.queries()[name](spark, SF_SMALL)), "customer")


def test_tables_are_spread_only_on_request(spark):
    from shoplens.sources.tables import SPREAD_SETTING, read_table

    before = spark.conf.get(SPREAD_SETTING)
    try:
        spark.conf.unset(SPREAD_SETTING)
        assert "Exchange" not in _plan(read_table(spark, SF_SMALL, "lineitem"))
        spark.conf.set(SPREAD_SETTING, "true")
        assert "RoundRobin" in _plan(read_table(spark, SF_SMALL, "lineitem"))
    finally:
        spark.conf.set(SPREAD_SETTING, before)
