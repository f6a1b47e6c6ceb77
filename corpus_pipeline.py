"""The corpus pipeline: quality classifier, line dedup, near-duplicate removal, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; :func:`run` writes every stage's
result as Parquet under the shared checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.llm import line_dedup, mixing, ngram_join, pieces, quality
from shoplens.llm.common import read, staged


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains the classifier on ``docs`` and keeps what it accepts."""
    return quality.judge(docs).filter("verdict.keep").select("row.*")


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeated runs of lines; a document all of whose words were such runs goes.  A document that loses lines
    gets a new n_chars."""
    counts = tuple(f"line_dedup {c} {len(docs.columns)}" for c in ("lines", "removed"))
    while set(counts) & set(docs.columns):
        counts = tuple(c + "_" for c in counts)
    cleaned = line_dedup.dedup_lines(docs, counts=counts)
    removed = F.col(f"`{counts[1]}`")
    kept = cleaned.filter((removed == 0) | F.col("text").rlike(r"\S"))
    n_chars = F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return kept.withColumn("n_chars", n_chars).drop(*counts)


def copy_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return ngram_join.without_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in mixed order."""
    return mixing.in_mixed_order(docs)


def in_file_order(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``position`` of ``docs``: gapless numbers from 0 in the order of its files, and of the rows in each.

    A scan may pack files in any order, so a row's place is its file's number and its row's in the file.  What is not a
    table of files as they are is written first, a file for each partition.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = staged(docs, "pipeline-order")
    place = (F.regexp_extract("_metadata.file_name", "part-(\\d+)", 1).alias("__part"), F.col("_metadata.file_name").alias("__file"),
             F.col("_metadata.row_index").alias("__row"))
    rows = docs.select("doc_id", "text", *place)
    before = Window.orderBy(F.length("__part"), "__part", "__file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("__part", "__file").agg(F.count(F.lit(1)).alias("__n"))  # a row for each file
    files = files.select(F.col("__file").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return rows.join(F.broadcast(files), F.col("__file") == F.col("__of")).select("doc_id", "text", (F.col("__start") + F.col("__row")).alias("position"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and position (in the mixed order) of every document."""
    return pieces.encode_documents(in_file_order(docs), pieces.default_model(), carry=("position",))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_filter),
    ("n-gram Jaccard join", copy_filter),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

#: SQL can express neither the classifier nor the encoding; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
