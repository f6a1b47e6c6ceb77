"""Order / order-detail joins and the sale-detail record.

- JOI1 ``detail_pairs``: the full outer equi-join with a ``match_state`` label, as a left join plus an anti join.
- JOI4 ``sale_details``: inner interval join — a detail meets its order when their times are within ``ttl``
  (both bounds inclusive); unmatched rows are never emitted.  Each (order, detail) pair appears exactly once.
- JOI5 ``sale_details_all``: plain inner join.
- JOI7 ``with_user``: left join with the latest user row; age from birthday (PRJ9), missing user → defaults.

Both sides are projected to the join's columns first, so the shuffle (and, in streams, the join state) carries
only what the output needs.  The equi-key (order_id) drives a sort-merge join; the time bound is a post-filter
inside the same join, so no pair outside the band is ever materialised.  AQE splits a skewed order_id partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import age_years, text_date, text_to_timestamp

DEFAULT_TTL_SECONDS = 100

SALE_COLUMNS = ("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "sku_name",
                "sku_price", "dt")


def order_side(orders: DataFrame) -> DataFrame:
    """Order fields the sale detail takes (PRJ8), plus the order's event time."""
    return orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
        (F.col("create_date") if "create_date" in orders.columns else text_date("create_time")).alias("dt"),
        text_to_timestamp("create_time").alias("order_ts"))


def detail_side(details: DataFrame) -> DataFrame:
    """Detail fields the sale detail takes (PRJ8): price as DOUBLE, plus the detail's arrival time."""
    return details.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("d_order_id"), "sku_id", "sku_name",
        F.col("order_price").try_cast("double").alias("sku_price"),
        text_to_timestamp("detail_time").alias("detail_ts"))


def within_ttl(ttl_seconds: int) -> Column:
    ttl = F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")
    return F.col("detail_ts").between(F.col("order_ts") - ttl, F.col("order_ts") + ttl)


def _sale(joined: DataFrame) -> DataFrame:
    return joined.select(*SALE_COLUMNS)


def sale_details(orders: DataFrame, details: DataFrame, ttl_seconds: int = DEFAULT_TTL_SECONDS) -> DataFrame:
    """JOI4 + PRJ8: order ⋈ detail on order id with |detail time − order time| ≤ ttl."""
    o, d = order_side(orders), detail_side(details)
    cond = (F.col("order_id") == F.col("d_order_id")) & within_ttl(ttl_seconds)
    return _sale(o.join(d, cond, "inner"))


def sale_details_all(orders: DataFrame, details: DataFrame) -> DataFrame:
    """JOI5 + PRJ8: order ⋈ detail on order id, no time bound."""
    o, d = order_side(orders), detail_side(details)
    return _sale(o.join(d, F.col("order_id") == F.col("d_order_id"), "inner"))


def detail_pairs(orders: DataFrame, details: DataFrame) -> DataFrame:
    """JOI1: the full outer join of orders and details with ``match_state`` in {both, order_only, detail_only}.

    Written as two skew-safe joins whose union is the full outer join: details ⟕ orders gives ``both`` and
    ``detail_only`` (AQE splits a hot order id's detail rows over several tasks — it cannot split either side of a
    full outer join); orders ▷ distinct detail keys gives ``order_only`` (the distinct is taken map-side first,
    so a hot order id reaches the anti join as one row per task).  The orders without lines are dealt out anew: left as
    they lie, they have the matched rows' partitioning, and Spark puts both joins, with all their sorts, into one task.
    """
    o = orders.select(F.col("id").alias("o_id"))
    d = details.select(F.col("id").alias("order_detail_id"), F.col("order_id").alias("d_order_id"))
    with_order = d.join(o, F.col("d_order_id") == F.col("o_id"), "left")
    state = F.when(F.col("o_id").isNotNull(), F.lit("both")).otherwise(F.lit("detail_only"))
    matched = with_order.select(F.col("d_order_id").alias("order_id"), "order_detail_id", state.alias("match_state"))
    keys = d.select("d_order_id").distinct()
    # labelled as the full outer join labels it: a row with a non-null order id is order_only
    lonely_state = F.when(F.col("o_id").isNotNull(), F.lit("order_only")).otherwise(F.lit("detail_only"))
    lonely = (o.join(keys, F.col("o_id") == F.col("d_order_id"), "left_anti")
              .select(F.col("o_id").alias("order_id"), F.lit(None).cast("string").alias("order_detail_id"),
                      lonely_state.alias("match_state")))
    return matched.unionByName(lonely.hint("rebalance"))


def with_user(sales: DataFrame, users_latest: DataFrame, as_of: str | Column) -> DataFrame:
    """JOI7 + PRJ9: user gender, level and age (whole days / 365 up to ``as_of``); no user → null, null, 0."""
    as_of_col = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    u = users_latest.select(F.col("id").alias("u_id"), F.col("gender").alias("user_gender"), "user_level",
                            age_years("birthday", as_of_col).alias("u_age"))
    j = sales.join(u, F.col("user_id") == F.col("u_id"), "left")
    return j.select("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
                    "user_gender", F.coalesce("u_age", F.lit(0)).cast("int").alias("user_age"), "user_level",
                    "sku_price", "sku_name", "dt")
