"""Stream sources and JSON ingest.

- SRC1 ``topic_stream``: a Kafka topic as a stream (``startingOffsets=latest``; offsets live in the checkpoint).
  No Kafka jar ships with this environment, so tests use ``file_stream``, which yields the same ``value`` column.
- SRC3 ``parse_records``: JSON text → typed columns with ``from_json`` (PERMISSIVE); malformed records are split
  off into a quarantine frame instead of failing the task.
- PRJ5 ``values``: the message value as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def topic_stream(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SRC1: one Kafka topic as a stream, with the Kafka source's own columns; ``max_offsets_per_trigger`` limits the
    rate of a catch-up."""
    rate = {"maxOffsetsPerTrigger": str(max_offsets_per_trigger)} if max_offsets_per_trigger else {}
    return (spark.readStream.format("kafka").options(**rate)
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .load())


def topic_pattern_stream(spark: SparkSession, bootstrap: str, pattern: str) -> DataFrame:
    """SRC4 transport: all topics matching a pattern (change events of one database)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribePattern", pattern)
            .load())


MESSAGE = "value string, timestamp timestamp, partition int, offset long"


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A topic kept as Parquet files of messages (``value``, ``timestamp``, ``partition``, ``offset``): the columns a
    Kafka source has, so arrival time and order survive."""
    r = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stand-in for a topic: a folder of JSON-lines text files, one record per line, as ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def values(messages: DataFrame) -> DataFrame:
    """PRJ5: the message value as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def _typed(text, kind):
    """A field's text as a value of ``kind``; nested kinds are JSON."""
    if isinstance(kind, (ArrayType, StructType, MapType)):
        return F.from_json(text, kind)
    return text.try_cast(kind)


def parse_records(messages: DataFrame, schema: StructType, keep: tuple[str, ...] = (), extra: str | None = None) -> DataFrame:
    """SRC3: typed records from JSON text; a ``_corrupt_record`` column holds the raw text of malformed rows.

    Fields are read as text and cast to the schema's types, so a number sent as JSON text is as good as a number (change
    after-images are all text).  A record that is no JSON object, or has a field whose text is no value of its type, is
    malformed.  ``keep`` carries columns of the message along (a topic's ``timestamp``, ``partition``, ``offset``);
    ``extra`` names a map column for the fields that the schema doesn't list.

    The parsed record comes out of a generator (of one row): filters on its fields stay above it, so a text is parsed once,
    not once for each place that a filter pushed below names a field.
    """
    names = [f.name for f in schema.fields]
    as_text = StructType([StructField(n, StringType()) for n in names] + [StructField(CORRUPT, StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json("_raw", as_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = messages.select(*[F.col(k).alias(f"_keep_{k}") for k in keep], text.alias("_raw"))
    rows = rows.select("*", F.explode(F.array(parsed)).alias("r"))
    typed = {f.name: _typed(F.col(f"r.{f.name}"), f.dataType) for f in schema.fields}
    misfit = F.lit(False)
    for f in schema.fields:
        if f.dataType != StringType():
            misfit = misfit | (F.col(f"r.{f.name}").isNotNull() & typed[f.name].isNull())
    # an empty or null message parses to a null struct: malformed as well
    corrupt = (F.when(F.col("r").isNull(), F.coalesce(F.col("_raw"), F.lit("")))
               .when(misfit, F.col("_raw")).otherwise(F.col(f"r.{CORRUPT}")))
    columns = [F.col(f"_keep_{k}").alias(k) for k in keep] + [typed[n].alias(n) for n in names]
    if extra:
        fields = F.from_json(F.col("_raw"), MapType(StringType(), StringType()))
        columns.append(F.map_filter(fields, lambda k, v: ~k.isin(*names)).alias(extra))
    return rows.select(*columns, corrupt.alias(CORRUPT))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(parsed: DataFrame) -> DataFrame:
    """Malformed records with their raw text, for a side output."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"))
