"""What a query's work grows with: records parsed once, sales made once, windows folded without copies, bounded sorts."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplens.functions import columns as C
from shoplens.operators import alerts, search_index
from shoplens.schemas import ORDER_INFO
from shoplens.sources import ingest


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_topic_is_parsed_once(spark):
    # a filter on parsed fields, pushed below the projection, would parse the text again for each field it names
    plan = _optimized(E.queries()["chain_sale_detail"](spark, SF_SMALL))
    assert plan.count("from_json(") == 2  # orders and lines


def test_an_after_image_is_built_once_a_row(spark):
    plan = _optimized(E.queries()["chain_sale_detail"](spark, SF_SMALL))
    assert plan.count("struct(name, consignee,") == 1 and plan.count("struct(name, sku_name,") == 1


def test_last_entries_of_repeated_nameless_and_missing_names(spark):
    rows = [([("a", "1"), ("b", "2"), ("a", None), (None, "x"), (None, "y"), ("b", "3"), ("c", "4")],), ([("b", "1"), ("a", "2")],),
            ([("b", "1"), None, (None, "2")],), ([],), (None,)]
    df = spark.createDataFrame(rows, "after array<struct<name:string,value:string>>")
    got = [r[0] if r[0] is None else [tuple(x) for x in r[0]] for r in df.select(C.last_entries()).collect()]
    assert got == [[("a", None), ("b", "3"), ("c", "4")], [("b", "1"), ("a", "2")], [("b", "1")], [], None]


def test_filters_after_parsing_keep_their_results(spark):
    texts = ['{"id": "1", "total_amount": "2.5"}', '{"id": "2", "total_amount": "x"}', "[]", "", None, '{"id": null}']
    parsed = ingest.parse_records(spark.createDataFrame([(t,) for t in texts], "value string"), ORDER_INFO)
    assert _optimized(ingest.good_records(parsed).where(F.col("id") == "1")).count("from_json(") == 1
    assert [(r.id, r.total_amount) for r in ingest.good_records(parsed).where("id IS NOT NULL").collect()] == [("1", 2.5)]
    assert sorted(r.raw for r in ingest.quarantine(parsed).collect()) == sorted([texts[1], "[]", "", ""])


def test_sales_with_users_are_made_once(spark):
    # the lookup and the join read the stored sales; neither goes back to the change log
    plan = _optimized(E.queries()["chain_sale_detail_user"](spark, SF_SMALL))
    assert "l_orderkey" not in plan and "from_json(" not in plan


def test_pair_joins_lie_in_stages_of_their_own(spark):
    # with like partitioning on both sides, the union would run both joins and their four sorts in one task
    plan = E.queries()["order_detail_pairs_since"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    lonely = plan[:plan.index("LeftAnti")].rsplit("Exchange", 1)[1]
    assert "REBALANCE" in lonely


def test_panes_are_not_copied_into_windows(spark):
    plan = _optimized(E.queries()["coupon_alert_panes"](spark, SF_SMALL))
    assert "Expand" not in plan and "explode(array(" in plan  # two copies of a pane


def test_panes_of_firing_windows_equal_firing_windows(spark):
    rows = [("m", f"u{i % 5}" if i % 7 else None, ["coupon", "addCart", None, "coupon", "share", "clickItem"][i % 6 if i % 4 == 0 else i % 5], f"i{i % 3}", t)
            for i, t in enumerate([-700_000, -1, 0, 1, 4_999, 5_000, 5_000, 295_000, 299_999, 300_000, 304_999, 305_000, 600_001, 610_000, 611_000, 899_999] * 3)]
    rows += [(None, f"u{i}", "coupon", None, 2_000_000 + 1000 * i) for i in range(9)] + [("m", "u1", "coupon", "i", None)]
    events = alerts._base(spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, ts long"))
    show = lambda df: sorted(map(str, df.collect()))
    assert show(alerts.pane_fold(events)) == show(alerts.window_fold(events))
    for n in (1, 3, 4):
        want = show(alerts.firing(alerts.window_fold(events), n))
        assert want and show(alerts.firing(alerts.pane_fold(events, min_uids=n), n)) == want


def test_block_bounds_are_dealt_before_they_are_folded(spark):
    rows = [(0, "a", "1-0", 1, 0.5), (0, "a", "1-0", 2, 0.75), (0, "a", "1-1", 3, 0.25), (1, None, "1-0", 1, 0.5)]
    df = search_index.block_bounds(spark.createDataFrame(rows, "folder int, token string, block string, key long, gain double"), 2)
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(0, "a", "1-0", 0.75, 2), (0, "a", "1-1", 0.25, 1), (1, None, "1-0", 0.5, 1)], key=str)
    steps = re.findall(r"Exchange|HashAggregate", df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1])
    assert steps[-1] == "Exchange" and steps.count("Exchange") == 1  # from the top down: the exchange comes first
