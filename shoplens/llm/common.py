"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.session import checkpoint_dir

ROWS_PER_BUCKET = 4_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: cuts the lineage with files that
    outlive any executor."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/shoplens-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, unless PYTHONPATH has it there already."""
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_shoplens_shipped", False):
        return
    packed = Path(tempfile.mkdtemp(prefix="shoplens-code-"), "shoplens_code.zip")  # the driver serves it to executors
    with zipfile.ZipFile(packed, "w") as out:
        for f in sorted((root / "shoplens").rglob("*.py")):
            out.write(f, f.relative_to(root))
    context.addPyFile(str(packed))
    context._shoplens_shipped = True


FILTER_BITS = 1 << 24  # 2 MB


def maybe_among(keys: DataFrame, key: Column):
    """A test for rows whose 64-bit ``key`` may be among that of ``keys``: a function from the key column to a boolean
    column, true for all of ``keys`` and for few others while these are far fewer than ``FILTER_BITS``.

    The keys set bits in a bitmap of fixed size, which is broadcast: applied before a join on the key, it keeps rows
    without a partner out of the shuffle.  The join itself still decides.
    """
    place = F.pmod(key, F.lit(FILTER_BITS))
    bits = keys.select(place.alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p % 64 AS INT))").alias("bit"))
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most FILTER_BITS / 64 rows
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[found.word.to_numpy(np.int64)] = found.bits.to_numpy(np.int64)
    bitmap = keys.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def marked(places: pd.Series) -> pd.Series:
        p = places.to_numpy(np.int64)
        return pd.Series((bitmap.value[p >> 6] >> (p & 63)) & 1 == 1)

    return lambda column: marked(F.pmod(column, F.lit(FILTER_BITS)))


def bucket_count(rows: int, least: int = 64) -> int:
    """Buckets of about ``ROWS_PER_BUCKET`` rows; at most 2^20."""
    return max(least, min(1 << 20, -(-rows // ROWS_PER_BUCKET)))


def hash_bucket(h: Column, buckets: int) -> Column:
    """Equal-width bucket of a signed 64-bit hash, increasing with the hash as a signed number."""
    return F.least(F.floor((h.cast("double") / F.lit(2.0**64) + F.lit(0.5)) * buckets).cast("long"), F.lit(buckets - 1).cast("long"))


def numbered(df: DataFrame, bucket: str, order: list[Column], out: str, by: tuple[str, ...] = (), total: str | None = None) -> DataFrame:
    """Gapless numbers from 0 over the rows sorted by (``bucket``, ``order``), within each value of ``by``.

    No task sorts more than one (``by``, ``bucket``): bucket sizes are counted (combined map-side), summed up in bucket
    order, and each row adds its place within its bucket.  ``order`` must agree with the bucket order.  ``total`` names
    an optional column with the number of rows of the row's ``by``.
    """
    keys = [*by, bucket]
    sums = Window.partitionBy(*by) if by else Window.partitionBy()
    starts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    starts = starts.select(
        *(F.col(k).alias(f"__k_{k}") for k in keys),
        F.coalesce(F.sum("__n").over(sums.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"),
        *([F.sum("__n").over(sums).alias("__total")] if total else []),
    )
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    placed = df.join(starts, on)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    placed = placed.withColumn(out, (F.col("__start") + place - 1).cast("long"))
    if total:
        placed = placed.withColumn(total, F.col("__total").cast("long"))
    return placed.drop("__start", "__total", *(f"__k_{k}" for k in keys))
