"""Orders: cleaning (dates, hour, phone mask), the order-table column names, GMV of a day and by hour.

Money is summed as DECIMAL(18,2) — exact and order-independent, so partial sums merged in any order give the
same total — and handed out as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import mask_middle4, mask_prefix4, money, text_date, text_hour

MASKS = {"prefix4": mask_prefix4, "middle4": mask_middle4}


def clean_orders(orders: DataFrame, mask: str = "prefix4") -> DataFrame:
    """PRJ2 + PRJ3/PRJ4: derive ``create_date`` / ``create_hour`` from the text time and mask the phone."""
    return (orders
            .withColumn("create_date", text_date("create_time"))
            .withColumn("create_hour", text_hour("create_time"))
            .withColumn("consignee_tel", MASKS[mask]("consignee_tel")))


def table_columns(df: DataFrame) -> DataFrame:
    """SNK2 naming: every field name upper-cased for the order table."""
    return df.toDF(*[c.upper() for c in df.columns])


def gmv_total(orders_clean: DataFrame, date: str) -> DataFrame:
    """AGG4: GMV of one day; null when the day has no order."""
    return (orders_clean.where(F.col("create_date") == F.lit(date))
            .agg(F.sum(money("total_amount")).cast("double").alias("gmv"))
            .select(F.lit(date).alias("create_date"), "gmv"))


def gmv_hours(orders_clean: DataFrame, date: str) -> DataFrame:
    """AGG5: GMV per create hour of one day."""
    return (orders_clean.where(F.col("create_date") == F.lit(date))
            .groupBy("create_hour")
            .agg(F.sum(money("total_amount")).cast("double").alias("gmv")))
