"""Session helpers.

The library never creates a session behind the caller's back; ``build_session`` is the local session of tests and the
bench, ``submitted_session`` the one spark-submit configures.  Two settings matter to correctness:

- ``spark.sql.session.timeZone`` must be UTC: epoch-millisecond times are formatted into dates and hours.
  ``ensure_utc`` sets it where it differs.
- ``spark.checkpoint.dir`` is read from the session (a shared folder on a cluster).  A scratch folder is set only where
  the session has none and runs in local mode; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shoplens") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.shoplens.scan.spread", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    checkpoint_dir(spark)
    return spark


def submitted_session(app_name: str) -> SparkSession:
    """The session that spark-submit and the cluster's defaults configure; only the time zone is ours."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Dates/hours are derived from epoch millis in UTC, the same rule as the oracle."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once an application, unless PYTHONPATH has it there already."""
    root, context = Path(__file__).resolve().parents[1], spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_shoplens_shipped", False):
        return
    packed = Path(tempfile.mkdtemp(prefix="shoplens-code-"), "shoplens_code.zip")  # the driver serves it to executors
    with zipfile.ZipFile(packed, "w") as out:
        for f in sorted((root / "shoplens").rglob("*.py")):
            out.write(f, f.relative_to(root))
    context.addPyFile(str(packed))
    context._shoplens_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch folder only in local mode, when none is configured."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="shoplens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, e.g. for a streaming query's checkpointLocation."""
    return os.path.join(checkpoint_dir(spark), name)
