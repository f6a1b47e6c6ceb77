"""Dashboard questions: today-vs-yesterday hours (JOI8), hour maps (PRJ13), the KPI list (AGG8),
sale-detail search and paging (FLT7, ORD1), shares (AGG10, AGG11), sales by region (AGG12),
product ranking (AGG13) and the match/max query (FLT6 + AGG7).

One scan answers both days: rows of ``date`` and ``date - 1`` are read once and folded by conditional sums.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.columns import money
from shoplens.functions.text import matches
from shoplens.operators.dau import active_and_new
from shoplens.operators.gmv import gmv_total


def _yesterday(date: str) -> str:
    return (_dt.date.fromisoformat(date) - _dt.timedelta(days=1)).isoformat()


def hour_axis(spark) -> DataFrame:
    """The fixed 00–23 axis (24 rows)."""
    return spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def compare_hours(rows: DataFrame, date: str, day_col: str, hour_col: str, value: Column | None,
                  out_type: str) -> DataFrame:
    """JOI8: (hour, today, yesterday) on the 00–23 axis, missing hour → 0.

    ``value`` None counts rows, else it is summed as money.  One filtered scan, one aggregate, then a left join
    of the 24-row axis with the per-hour result.  No broadcast hint: AQE picks the join from the result's measured
    size (the number of distinct hour texts is not bounded by the code when times are malformed).
    """
    yday = _yesterday(date)
    two_days = rows.where(F.col(day_col).isin(date, yday))
    if value is None:
        def agg(day: str) -> Column:
            return F.count_if(F.col(day_col) == F.lit(day))
    else:
        def agg(day: str) -> Column:
            return F.sum(F.when(F.col(day_col) == F.lit(day), money(value))).cast("double")
    by_hour = (two_days.groupBy(F.col(hour_col).alias("hour"))
               .agg(agg(date).alias("today"), agg(yday).alias("yesterday")))
    axis = hour_axis(rows.sparkSession)
    zero = F.lit(0).cast(out_type)
    return (axis.join(by_hour, "hour", "left")
            .select("hour", F.coalesce(F.col("today").cast(out_type), zero).alias("today"),
                    F.coalesce(F.col("yesterday").cast(out_type), zero).alias("yesterday")))


def hour_map(rows: DataFrame, date: str, day_col: str, hour_col: str, value: Column | None) -> DataFrame:
    """PRJ13: per day (``date`` and the day before) the hour → value map, plus its sorted ``hh:v`` text."""
    yday = _yesterday(date)
    v = F.count(F.lit(1)).cast("decimal(18,2)") if value is None else F.sum(money(value))
    per_hour = (rows.where(F.col(day_col).isin(date, yday))
                .groupBy(F.col(day_col).alias("day"), F.col(hour_col).alias("hour")).agg(v.alias("v")))
    maps = per_hour.groupBy("day").agg(F.map_from_entries(F.collect_list(F.struct("hour", "v"))).alias("hour_map"))
    text = F.array_join(F.array_sort(F.transform(F.map_entries("hour_map"),
                                                 lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))),
                        ",")
    which = F.when(F.col("day") == F.lit(date), F.lit("today")).otherwise(F.lit("yesterday"))
    return maps.select(which.alias("which"), "day", "hour_map", text.alias("hour_text"),
                       F.size("hour_map").alias("n_hours"))


# KPI ids and display names.
KPI_NAMES = {"dau": "新增日活", "new_mid": "新增设备", "order_amount": "GMV"}


def kpi_total(dau_rows: DataFrame, orders_clean: DataFrame, date: str, order_date: str | None = None) -> DataFrame:
    """AGG8: three rows (id, name, value): DAU of the day, new devices, GMV.  The logs are read once for both counts.

    ``order_date`` defaults to ``date`` (one date for all three, as the dashboard asks).
    """
    return kpi_rows(active_and_new(dau_rows, date), gmv_total(orders_clean, order_date or date))


def kpi_rows(counts: DataFrame, gmv: DataFrame) -> DataFrame:
    """AGG8 from one row (dau, new_mid) and one (gmv)."""
    entries = F.array(*(F.struct(F.lit(k).alias("id"), F.col(k).cast("double").alias("value")) for k in ("dau", "new_mid")))
    devices = counts.select(F.inline(entries))
    gmv = gmv.select(F.lit("order_amount").alias("id"), F.col("gmv").alias("value"))
    names = F.create_map(*[x for k, n in KPI_NAMES.items() for x in (F.lit(k), F.lit(n))])
    return (devices.unionByName(gmv)
            .select("id", names[F.col("id")].alias("name"), "value"))


def sale_search(sale_details: DataFrame, date: str | None, keyword: str = "", level: str | None = None) -> DataFrame:
    """FLT7: sale details of a day whose product name matches ``keyword`` (empty = all);
    ``level`` optionally restricts ``user_level``.  ``date`` None searches every day."""
    cond = matches("sku_name", keyword)
    if date is not None:
        cond = (F.col("dt") == F.lit(date)) & cond
    if level is not None:
        cond = cond & (F.col("user_level") == F.lit(level))
    return sale_details.where(cond)


def page(hits: DataFrame, start: int, size: int) -> DataFrame:
    """ORD1: rows ``start`` .. ``start + size - 1`` in (dt, order_detail_id) order, with the total hit count.

    The order is total (order_detail_id is unique), so pages are stable.  Spark plans ORDER BY + OFFSET/LIMIT as
    a top-k per partition; the total is a scalar subquery (its own aggregate job), not a join.
    """
    total = hits.agg(F.count(F.lit(1))).scalar()
    return (hits.orderBy("dt", "order_detail_id").offset(start).limit(size)
            .withColumn("total", total))


def page_after(hits: DataFrame, after: tuple[str, str] | None, size: int) -> DataFrame:
    """ORD1 for deep pages: the ``size`` rows behind the (dt, order_detail_id) that the page before ended with (None: the
    first page).  The position is a filter, so no task gathers the rows of earlier pages."""
    if after is not None:
        dt, detail = (F.lit(x) for x in after)
        hits = hits.where((F.col("dt") > dt) | ((F.col("dt") == dt) & (F.col("order_detail_id") > detail)))
    return hits.orderBy("dt", "order_detail_id").limit(size)


PAGE_PREFIXES = (4, 8, 12)  # leading characters of order_detail_id that name ever smaller ranges of a day


def page_by_ranges(hits: DataFrame, start: int, size: int, prefixes: tuple[int, ...] = PAGE_PREFIXES) -> DataFrame:
    """ORD1 for any page, asked by its number: the rows of :func:`page`, found through counted ranges.

    Days are counted first, then the ranges of (day, leading characters of the id) within the days that the page covers,
    and so on; each step leaves a contiguous region and the number of hits before it.  Only the last region is sorted, so
    no task gathers the rows of the pages before.  ``hits`` should be a stored table: each step is a small count over it
    (two columns, the region pushed down), and one row comes back to the driver.  ``order_detail_id`` must be unique and
    not null, as for ``page``.
    """
    total, skip = None, start
    region = hits
    for prefix in (None, *prefixes):
        cut = F.lit("") if prefix is None else F.substring("order_detail_id", 1, prefix)
        counts = region.groupBy("dt", cut.alias("cut")).agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy().orderBy("dt", "cut")  # one row a range of the region, not of the hits
        ranges = counts.withColumn("upto", F.sum("n").over(order))
        covered = (F.col("upto") > skip) & (F.col("upto") - F.col("n") < skip + size)
        key = F.struct("dt", "cut")
        found = ranges.agg(F.sum("n").alias("n"), F.min(F.when(covered, key)).alias("low"), F.max(F.when(covered, key)).alias("high"),
                           F.min(F.when(covered, F.col("upto") - F.col("n"))).alias("before")).first()
        total = found["n"] or 0 if total is None else total
        if found["low"] is None:
            return hits.where(F.lit(False)).withColumn("total", F.lit(total).cast("long"))
        skip -= found["before"]
        (first_day, first), (last_day, last) = found["low"], found["high"]
        region = region.where(_from(first_day, cut, first) & _upto(last_day, cut, last))
    return region.orderBy("dt", "order_detail_id").offset(skip).limit(size).withColumn("total", F.lit(total).cast("long"))


def _from(day: str | None, cut: Column, first: str) -> Column:
    """Rows at or behind (day, first); a null day sorts first."""
    if day is None:
        return F.col("dt").isNotNull() | (cut >= F.lit(first))
    return (F.col("dt") >= F.lit(day)) & ((F.col("dt") > F.lit(day)) | (cut >= F.lit(first)))


def _upto(day: str | None, cut: Column, last: str) -> Column:
    if day is None:
        return F.col("dt").isNull() & (cut <= F.lit(last))
    return F.col("dt").isNull() | ((F.col("dt") <= F.lit(day)) & ((F.col("dt") < F.lit(day)) | (cut <= F.lit(last))))


def _share(counts: DataFrame, key: str) -> DataFrame:
    # the grouped result has a handful of rows (genders, age bands), so a global window over it is cheap
    return counts.select(key, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def gender_share(sale_details: DataFrame) -> DataFrame:
    """AGG10: count and share per gender."""
    return _share(sale_details.groupBy("user_gender").agg(F.count(F.lit(1)).alias("n")), "user_gender")


# Age band labels (edges are our decision: 20 and 30 fall in the middle band).
AGE_BANDS = ("under_20", "20_30", "over_30")


def age_share(sale_details: DataFrame) -> DataFrame:
    """AGG11: count and share per age band: under 20, 20–30, over 30."""
    a = F.col("user_age")
    band = (F.when(a < 20, F.lit(AGE_BANDS[0])).when(a <= 30, F.lit(AGE_BANDS[1])).otherwise(F.lit(AGE_BANDS[2])))
    return _share(sale_details.groupBy(band.alias("age_band")).agg(F.count(F.lit(1)).alias("n")), "age_band")


def region_sales(orders: DataFrame, nation: DataFrame, region: DataFrame, step: int = 100) -> DataFrame:
    """AGG12: orders and amount per province, named through the nation/region dimension, classed in steps.

    Aggregated first (one partial row per province per task), then joined: the dimension join sees at most one
    row per province.
    """
    per = (orders.groupBy("province_id")
           .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(money("total_amount")).cast("double").alias("amount")))
    dim = (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
           .select(F.col("n_nationkey").cast("string").alias("province_id"), "n_name", "r_name"))
    return (per.join(dim, "province_id", "left")
            .select("province_id", "n_name", "r_name", "n_orders", "amount",
                    (F.floor(F.col("n_orders") / step) * step).cast("long").alias("class_lo")))


def product_top(details: DataFrame, n: int = 10) -> DataFrame:
    """AGG13: top ``n`` products by units sold; ties broken by name (a top-k report)."""
    per = details.groupBy("sku_name").agg(F.sum(F.col("sku_num").try_cast("long")).alias("num"))
    return per.orderBy(F.col("num").desc(), F.col("sku_name").asc()).limit(n)


def match_search(docs: DataFrame, text_col: str, query: str, order_by: str, n: int = 10) -> DataFrame:
    """FLT6: documents whose ``text_col`` matches ``query`` — the first ``n`` hits in ``order_by`` order, each with
    the total hit count (in the order of a stable key; by relevance: ``search_index.match_ranked``)."""
    hits = docs.where(matches(text_col, query))
    total = hits.agg(F.count(F.lit(1))).scalar()
    return hits.orderBy(order_by).limit(n).withColumn("total", total)


def match_max(docs: DataFrame, text_col: str, query: str, metric: str) -> DataFrame:
    """FLT6 + AGG7: number of documents matching ``query`` and the max of ``metric`` over them."""
    return (docs.where(matches(text_col, query))
            .agg(F.count(F.lit(1)).alias("total"), F.max(metric).alias(f"max_{metric}")))
