"""STR8 and STR5: a topic read and parsed once, its records committed as a table that all outputs of an app stream from.

Each micro-batch is written once, as ``<path>/batch=<n>/kind=<good | late | rejected>``, and appears by one rename, so a
reader never sees half a batch and a batch that is tried again changes nothing.  The app's main query, its rejects and
its late rows are queries over one kind each (:func:`records`).

A row is late when a stateful query behind the table can no longer use it: its ``kept`` time is at or behind the
greatest event time of the batches before, less the delay.  The query behind reads the batches in order, so its watermark
is never ahead of that mark, and no row that is passed on as good is dropped there: each row is good, late or rejected.
Where a query joins two topics, Spark's watermark follows the slower one; each topic's own mark decides here.

Readers follow the files by time and, as every file source, pass over files more than ``maxFileAge`` (a week) older than
the newest; a reader that was down for longer needs that option raised.
"""

from __future__ import annotations

from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType, TimestampType, IntegerType

from shoplens.functions.columns import text_to_timestamp
from shoplens.operators import alerts
from shoplens.sources.ingest import CORRUPT, parse_records

GOOD, LATE, REJECTED = "good", "late", "rejected"
TIME = "_time"  # a record's event time in epoch ms
CARRIED = {"timestamp": TimestampType(), "partition": IntegerType(), "offset": LongType()}


class Lateness(NamedTuple):
    """``time``: event time in epoch ms; ``kept``: the time up to which the query behind can use the row."""
    time: Column
    kept: Column
    delay: str


def by_time(time: Column, delay: str) -> Lateness:
    return Lateness(time, time, delay)


def log_lateness(delay: str = "1 day") -> Lateness:
    return by_time(F.col("ts"), delay)


def text_lateness(column: str, delay: str = "2 minutes", arrival: str | None = None) -> Lateness:
    time = F.unix_millis(text_to_timestamp(column))
    return by_time(F.coalesce(time, F.unix_millis(F.col(arrival))) if arrival else time, delay)


def alert_lateness(delay: str = "10 seconds", window_seconds: int = alerts.DEFAULT_WINDOW_SECONDS,
                   slide_seconds: int = alerts.DEFAULT_SLIDE_SECONDS, panes: bool = False) -> Lateness:
    """An event is of use until the last window with its pane closes; with ``panes``, until its pane does."""
    slide = slide_seconds * 1000
    ahead = slide if panes else window_seconds * 1000
    return Lateness(F.col("ts"), F.floor(F.col("ts") / F.lit(slide)) * slide + ahead, delay)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _mark_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    if batch_id == 0:
        return None
    return spark.read.schema("mark long").parquet(f"{path}/batch={batch_id - 1}/mark").first()["mark"]


def store_batch(parsed: DataFrame, path: str, batch_id: int, lateness: Lateness | None = None) -> None:
    """One micro-batch of ``parse_records`` into the table; done already if its folder is there.  The batch is read once."""
    spark, path = parsed.sparkSession, path.rstrip("/")
    final, staged = f"{path}/batch={batch_id}", f"{path}/_staged/batch={batch_id}"
    fs, target = _file_system(spark, final)
    if fs.exists(target):
        return
    mark = _mark_before(spark, path, batch_id)
    time, late = F.lit(None).cast("long"), F.lit(False)
    if lateness is not None:
        time = lateness.time
        if mark is not None:
            late = F.coalesce(lateness.kept <= F.lit(mark - int(pd.Timedelta(lateness.delay).total_seconds() * 1000)), F.lit(False))
    kind = F.when(F.col(CORRUPT).isNotNull(), REJECTED).when(late, LATE).otherwise(GOOD)
    rows = parsed.withColumn(TIME, time.cast("long")).withColumn("kind", kind).withColumnRenamed(CORRUPT, "raw")
    rows.write.mode("overwrite").partitionBy("kind").parquet(staged)
    seen = spark.read.schema(f"{TIME} long, kind string").parquet(staged).where(F.col("kind") != REJECTED).agg(F.max(TIME)).first()[0]
    newest = max((x for x in (mark, seen) if x is not None), default=None)
    spark.createDataFrame([(newest,)], "mark long").coalesce(1).write.mode("overwrite").parquet(f"{staged}/mark")
    if not fs.rename(_file_system(spark, staged)[1], target):
        raise OSError(f"could not publish {final}")


def start_intake(messages: DataFrame, schema: StructType, path: str, name: str, lateness: Lateness | None = None,
                 extra: str | None = None, trigger: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """The only query that reads the topic.  Records keep their message's time, partition and offset where it has them."""
    from shoplens.streaming import jobs

    checkpoint = jobs.own_checkpoint(messages.sparkSession, path, checkpoint)
    parsed = parse_records(messages, schema, tuple(c for c in CARRIED if c in messages.columns), extra)
    w = (parsed.writeStream.outputMode("append").queryName(name).option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, batch_id: store_batch(batch, path, batch_id, lateness)))
    return jobs._trigger(w, trigger or jobs.BATCH_INTERVAL).start()


def records(spark: SparkSession, path: str, schema: StructType, kind: str = GOOD, carried: tuple[str, ...] = (),
            extra: str | None = None) -> DataFrame:
    """One kind of the table's records as a stream: typed rows, for rejected ones their raw text.  ``carried`` are the
    message columns that the topic's source has."""
    fields = [StructField("raw", StringType())] if kind == REJECTED else [*schema.fields, *([StructField(extra, MapType(StringType(), StringType()))] if extra else [])]
    fields += [StructField(c, CARRIED[c]) for c in carried]
    return spark.readStream.schema(StructType(fields)).parquet(f"{path.rstrip('/')}/batch=*/kind={kind}")
