"""Daily active devices: first log per device per day, the seen-device filter, totals, hours, new devices.

Every aggregate here is decomposable (min over a struct, count), so Spark aggregates map-side before the
shuffle: a device that sends a third of all logs still ships one partial row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.columns import log_date, log_hour

LOG_COLUMNS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs")


def with_log_time(logs: DataFrame) -> DataFrame:
    """PRJ1: add ``logdate`` (yyyy-MM-dd) and ``loghour`` (HH) from the epoch-ms ``ts``."""
    return logs.withColumn("logdate", log_date("ts")).withColumn("loghour", log_hour("ts"))


def first_log_per_device(logs: DataFrame, method: str = "aggregate") -> DataFrame:
    """AGG1 / WIN3: one row per (mid, logdate): the log with the smallest ``ts``.

    ``aggregate`` (default) takes ``min(struct(ts, ...))`` — a partial aggregate, and deterministic on ties
    because the whole row breaks them.  ``window`` is the row_number form (a full sort of each group; kept as
    the batch alternative, it is not usable in streams).
    """
    if "logdate" not in logs.columns:
        logs = with_log_time(logs)
    rest = [c for c in logs.columns if c not in ("mid", "logdate", "ts")]
    if method == "window":
        w = Window.partitionBy("mid", "logdate").orderBy(F.col("ts").asc(), *[F.col(c).asc() for c in rest])
        return logs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    first = F.min(F.struct("ts", *rest)).alias("_first")
    return (logs.groupBy("mid", "logdate").agg(first)
            .select("mid", "logdate", "_first.*")
            .select(*logs.columns))


def first_times(logs: DataFrame) -> DataFrame:
    """The time and hour of each (device, day)'s first log: ``min(ts)``, a hash aggregate over three columns.  Enough for
    every question that counts devices by day or hour."""
    if "logdate" not in logs.columns:
        logs = logs.withColumn("logdate", log_date("ts"))
    first = logs.groupBy("mid", "logdate").agg(F.min("ts").alias("ts"))
    return first.withColumn("loghour", log_hour("ts"))


def unseen_logs(logs: DataFrame, seen: DataFrame) -> DataFrame:
    """FLT4 / JOI6: drop logs whose device is already in the seen set of the log's own day.

    ``seen`` has (mid, logdate).  A ``left_anti`` join; Catalyst / AQE broadcast the seen side only when its
    measured size is under the broadcast threshold, else both sides shuffle on (mid, logdate).
    """
    if "logdate" not in logs.columns:
        logs = with_log_time(logs)
    keys = seen.select("mid", "logdate").distinct()
    return logs.join(keys, ["mid", "logdate"], "left_anti")


def daily_active(logs: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """DAU2 in batch form: FLT4 then AGG1 — one row per (mid, logdate) for devices not seen before."""
    logs = with_log_time(logs) if "logdate" not in logs.columns else logs
    if seen is not None:
        logs = unseen_logs(logs, seen)
    return first_log_per_device(logs)


def seen_set(dau_rows: DataFrame) -> DataFrame:
    """SNK5, batch form: the distinct (logdate, mid) pairs already counted."""
    return dau_rows.select("logdate", "mid").distinct()


def dau_total(dau_rows: DataFrame, date: str) -> DataFrame:
    """AGG2: ``count(*)`` of the DAU table for one day (filter pushed into the scan / partition pruning)."""
    return (dau_rows.where(F.col("logdate") == F.lit(date))
            .agg(F.count(F.lit(1)).alias("dau"))
            .select(F.lit(date).alias("logdate"), "dau"))


def dau_hours(dau_rows: DataFrame, date: str) -> DataFrame:
    """AGG3: DAU per hour of first log for one day."""
    return (dau_rows.where(F.col("logdate") == F.lit(date))
            .groupBy("loghour").agg(F.count(F.lit(1)).alias("dau")))


def _day_number():
    """The day as a whole number: text has no fixed width, which would turn its minimum into a sort of all rows."""
    return F.unix_date(F.to_date("logdate"))


def new_devices(dau_rows: DataFrame, date: str) -> DataFrame:
    """AGG9 (our semantics): devices whose first-ever active day is ``date``.

    The first day per device is a partial ``min``; only days up to ``date`` are read (pushed filter).
    """
    firsts = (dau_rows.where(F.col("logdate") <= F.lit(date))
              .groupBy("mid").agg(F.min(_day_number()).alias("first_day")))
    return (firsts.where(F.col("first_day") == F.unix_date(F.to_date(F.lit(date))))
            .agg(F.count(F.lit(1)).alias("new_mid"))
            .select(F.lit(date).alias("logdate"), "new_mid"))


def active_and_new(dau_rows: DataFrame, date: str) -> DataFrame:
    """AGG2 and AGG9 in one scan of the days up to ``date``: devices active on it, and those of them never seen before.
    Per device one partial row: its first day, and whether it was active on ``date``."""
    today = F.unix_date(F.to_date(F.lit(date)))
    per = (dau_rows.where(F.col("logdate") <= F.lit(date))
           .groupBy("mid").agg(F.min(_day_number()).alias("first_day"), F.bool_or(F.col("logdate") == F.lit(date)).alias("active")))
    return per.agg(F.count_if("active").alias("dau"), F.count_if(F.col("first_day") == today).alias("new_mid"))


def split_at_noon(logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two 'batches' of each day: logs before 12:00 and from 12:00 on (used to exercise FLT4)."""
    logs = with_log_time(logs) if "logdate" not in logs.columns else logs
    return logs.where(F.col("loghour") < "12"), logs.where(F.col("loghour") >= "12")
