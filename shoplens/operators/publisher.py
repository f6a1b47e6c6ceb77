"""The dashboard's two questions over the stored tables (SRC5 + FLT3 + AGG2-8 + JOI8).

``realtime_total(date)`` → the KPI rows; ``realtime_hours(id, date)`` → (hour, today, yesterday) for ``dau`` or
``order_amount``.  Both read the day-partitioned DAU table (SNK1) and order table (SNK2), so a day's question prunes
to that day's folders (and the day before for the comparison; all days up to the date for new devices).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import dashboard
from shoplens.sinks import read_dau_times, runs

ROLLED_HOURS = "logdate string, loghour string, n long"
ROLLED_NEW = "logdate string, n long"
ROLLED_AMOUNTS = "create_date string, create_hour string, amount decimal(38,2), n long"


def dau_table(spark: SparkSession, path: str) -> DataFrame:
    return read_dau_times(spark, path)


def order_table(spark: SparkSession, path: str) -> DataFrame:
    """The order table with the operators' lower-case names (the day filter still prunes ``CREATE_DATE``)."""
    df = spark.read.parquet(path)
    return df.toDF(*[c.lower() for c in df.columns])


def realtime_total(spark: SparkSession, dau_path: str, orders_path: str, date: str,
                   order_date: str | None = None) -> DataFrame:
    """AGG8: dau, new_mid, order_amount for one day (``order_date`` defaults to ``date``)."""
    return dashboard.kpi_total(dau_table(spark, dau_path), order_table(spark, orders_path), date, order_date)


def realtime_hours(spark: SparkSession, dau_path: str, orders_path: str, kpi_id: str, date: str) -> DataFrame:
    """JOI8 for ``dau`` (counts) or ``order_amount`` (GMV); any other id has no data (empty result)."""
    if kpi_id == "dau":
        return dashboard.compare_hours(dau_table(spark, dau_path), date, "logdate", "loghour", None, "long")
    if kpi_id == "order_amount":
        return dashboard.compare_hours(order_table(spark, orders_path), date, "create_date", "create_hour",
                                       F.col("total_amount"), "double")
    return spark.createDataFrame([], "hour string, today double, yesterday double")


# ---- from roll-ups: what a refresh every few seconds reads --------------------------------------------------------

def _months(*dates: str) -> list[str]:
    return sorted({d[:7] for d in dates})


def rollup_total(spark: SparkSession, dau_path: str, orders_path: str, date: str, order_date: str | None = None) -> DataFrame:
    """AGG8 from the roll-ups beside the stored tables: some rows of one month each, whatever the number of logs and orders."""
    order_date = order_date or date
    hours = runs.read_runs(spark, f"{dau_path}.hours", ROLLED_HOURS, _months(date)).where(F.col("logdate") == date)
    new = runs.read_runs(spark, f"{dau_path}.new", ROLLED_NEW, _months(date)).where(F.col("logdate") == date)
    amounts = runs.read_runs(spark, f"{orders_path}.amounts", ROLLED_AMOUNTS, _months(order_date)).where(F.col("create_date") == order_date)
    zero = F.lit(0).cast("long")
    counts = (hours.select(F.col("n").alias("dau"), zero.alias("new_mid")).unionByName(new.select(zero.alias("dau"), F.col("n").alias("new_mid")))
              .agg(F.coalesce(F.sum("dau"), zero).alias("dau"), F.coalesce(F.sum("new_mid"), zero).alias("new_mid")))
    return dashboard.kpi_rows(counts, amounts.agg(F.sum("amount").cast("double").alias("gmv")))


def rollup_hours(spark: SparkSession, dau_path: str, orders_path: str, kpi_id: str, date: str) -> DataFrame:
    """JOI8 from the roll-ups, as ``realtime_hours``."""
    yday = dashboard._yesterday(date)
    if kpi_id == "dau":
        rows = runs.read_runs(spark, f"{dau_path}.hours", ROLLED_HOURS, _months(yday, date))
        return dashboard.compare_hours(rows, date, "logdate", "loghour", F.col("n"), "long")
    if kpi_id == "order_amount":
        rows = runs.read_runs(spark, f"{orders_path}.amounts", ROLLED_AMOUNTS, _months(yday, date))
        return dashboard.compare_hours(rows, date, "create_date", "create_hour", F.col("amount"), "double")
    return spark.createDataFrame([], "hour string, today double, yesterday double")
