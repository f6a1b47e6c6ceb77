"""SRC5: table reads.  Parquet only; Catalyst prunes columns and pushes filters into the scan.

Scan parallelism comes from the files' splits.  The test tables are one file and one row group each, so everything up
to the first shuffle would run in one task; tests and the bench set ``spark.shoplens.scan.spread`` to ``true``, which
deals the scanned rows round-robin over the session's slots.  It is off unless asked for.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SMALL_TABLES = ("region", "nation")  # a handful of rows, never dealt out
SPREAD_SETTING = "spark.shoplens.scan.spread"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if spread and name not in SMALL_TABLES and spark.conf.get(SPREAD_SETTING, "false") == "true":
        df = df.repartition(spark.sparkContext.defaultParallelism)
    return df


class Tables:
    """Lazy handle on the test tables of one scale directory (each table read once per handle)."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.spread = spread
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name, self.spread)
        return self._cache[name]
