"""FLT6 with relevance: a stored index of token postings, BM25 scores, top-k that skips blocks by exact score bounds.

Documents are dealt into blocks of about ``BLOCK_DOCS`` by their length class and a hash, so that the documents of a block
score alike (the shorter of two documents with a token scores higher).  The index is three tables:

- ``postings`` (token, block, key, gain), in ``TOKEN_FILES`` folders by a hash of the token;
- ``bounds`` (token, block, best), the greatest gain of a token in a block, in the same folders;
- ``totals``, one row: the number of documents and of their tokens, and the key's type.

``gain`` is what a document's term frequency and length make of a token, without the token's weight.  A query opens the
folders of its own tokens.  A block's bound is the sum of its tokens' weighted best gains; the documents that have those
best gains reach the greatest of them alone, one in each block, so the k-th greatest of these is a lower limit for the
k-th score, and blocks whose bound stays under it are skipped without loss.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.text import query_tokens

# The usual parameters of BM25.
K1, B = 1.2, 0.75
BLOCK_DOCS = 128
TOKEN_FILES = 64
BOUNDS_TOKENS = 4_000_000  # tokens of the texts for each task that folds postings into bounds
SCALE = "decimal(18,6)"  # scores are compared to six places
SLACK = 1e-5  # more than rounding a score can move it

# Scripts without word breaks: each character is a token of its own.
_ALONE = "[぀-ヿ㐀-䶿一-鿿가-힯]"
_SPLIT = r"[^\p{L}\p{N}]+"


def index_tokens(c: Column | str) -> Column:
    """A text's tokens, with repeats: runs of letters and digits, lower-cased, characters of scripts without word breaks
    one by one.  A null text has none."""
    col = F.col(c) if isinstance(c, str) else c
    apart = F.regexp_replace(F.lower(col), f"({_ALONE})", " $1 ")
    return F.coalesce(F.filter(F.split(apart, _SPLIT), lambda t: t != F.lit("")), F.array().cast("array<string>"))


def asked_tokens(query: str) -> list[str]:
    return query_tokens(re.sub(f"({_ALONE})", r" \1 ", query or ""))


def _folder(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(TOKEN_FILES)).cast("int")


def _counts(words: Column) -> Column:
    """(token, tf) of one text, within its row: the runs of its sorted words."""
    ordered = F.array_sort(words)
    behind = F.concat(F.array(F.lit(None).cast("string")), ordered)
    marks = F.transform(F.arrays_zip(ordered.alias("w"), behind.alias("p")), lambda x, i: F.struct(x["w"].alias("token"), i.alias("at"), x["p"].alias("p")))
    starts = F.filter(marks, lambda x: x["token"].isNotNull() & ~x["token"].eqNullSafe(x["p"]))
    ends = F.concat(F.slice(F.transform(starts, lambda x: x["at"]), 2, F.size(words)), F.array(F.size(words)))
    return F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")),
                       lambda x: F.struct(x["s"]["token"].alias("token"), (x["e"] - x["s"]["at"]).alias("tf")))


def write_index(docs: DataFrame, key: str, text: str, path: str) -> None:
    """Builds the index of ``docs`` under ``path``.  ``key`` must be unique; documents without tokens are in no posting and
    not counted.  A token's postings are spread over tasks (the folder is rebalanced), so a word of
    every document is no task's burden."""
    spark, path = docs.sparkSession, path.rstrip("/")
    words = docs.select(F.col(key).alias("key"), index_tokens(text).alias("words"))
    words = words.select("key", "words", F.size("words").alias("length")).where("length > 0")
    totals = words.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.col("length").cast("long")), F.lit(0)).alias("n_tokens"),
                       F.lit(docs.schema[key].dataType.simpleString()).alias("key_type"))
    totals.coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")
    n_docs, n_tokens, key_type = spark.read.parquet(f"{path}/totals").first()
    mean, blocks = n_tokens / max(n_docs, 1), max(1, -(-n_docs // BLOCK_DOCS))

    share = F.floor(F.log2("length") * 4).cast("int")  # classes a quarter of an octave wide
    counted = words.select("key", "length", F.explode(_counts(F.col("words"))).alias("c")).select("key", "length", "c.token", "c.tf")
    gain = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean)))
    block = F.concat_ws("-", share, F.pmod(F.xxhash64("key"), F.lit(blocks)))
    postings = counted.select("token", block.alias("block"), "key", gain.alias("gain"), _folder(F.col("token")).alias("folder"))
    (postings.hint("rebalance", "folder").sortWithinPartitions("folder", "token", "block").write.mode("overwrite")
     .partitionBy("folder").parquet(f"{path}/postings"))
    stored = spark.read.schema(_POSTINGS.format(key_type)).parquet(f"{path}/postings")
    bounds = block_bounds(stored, -(-n_tokens // BOUNDS_TOKENS))
    bounds.hint("rebalance", "folder").sortWithinPartitions("folder", "token").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/bounds")


def block_bounds(postings: DataFrame, tasks: int) -> DataFrame:
    """The greatest gain and the number of postings of each token in each block.  The postings are dealt by these before any
    hash table, to as many tasks as their number asks for: few share a token and a block, so folding each task's share of
    the files first would hold nearly all of it at once and save no shuffle."""
    keys = ("folder", "token", "block")
    return postings.select(*keys, "gain").repartition(max(1, tasks), *keys).groupBy(*keys).agg(F.max("gain").alias("best"), F.count(F.lit(1)).alias("n"))


_POSTINGS = "token string, block string, key {}, gain double, folder int"
_BOUNDS = "token string, block string, best double, n long, folder int"


def _of_tokens(spark: SparkSession, path: str, schema: str, tokens: list[str]) -> DataFrame:
    """The rows of the query's tokens; folders and row groups of other tokens are not read."""
    if not tokens:
        return spark.createDataFrame([], schema)
    folders = [r[0] for r in spark.createDataFrame([(t,) for t in tokens], "t string").select(_folder(F.col("t"))).distinct().collect()]
    return spark.read.schema(schema).parquet(path).where(F.col("folder").isin(folders) & F.col("token").isin(tokens))


def open_blocks(spark: SparkSession, path: str, query: str, n: int) -> DataFrame:
    """(token, block, weight) of the blocks that may hold one of the ``n`` best documents, with their tokens' weights."""
    tokens, path = asked_tokens(query), path.rstrip("/")
    total = spark.read.parquet(f"{path}/totals").select("n_docs").scalar()
    bounds = _of_tokens(spark, f"{path}/bounds", _BOUNDS, tokens)
    found = bounds.groupBy("token").agg(F.sum("n").alias("df"))  # one row a token of the query
    weight = F.ln(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = found.select(F.col("token").alias("w_token"), weight.alias("weight"))
    weighted = bounds.join(weights, F.col("token") == F.col("w_token")).select("token", "block", "weight", (F.col("weight") * F.col("best")).alias("most"))
    blocks = weighted.groupBy("block").agg(F.sum("most").alias("bound"), F.max("most").alias("sure"))
    best = blocks.orderBy(F.col("sure").desc()).limit(n).agg(F.count(F.lit(1)).alias("have"), F.min("sure").alias("limit"))
    limit = best.select(F.when(F.col("have") == n, F.col("limit")).otherwise(F.lit(0.0))).scalar()
    kept = blocks.where(F.col("bound") + SLACK >= limit).select(F.col("block").alias("k_block"))
    return weighted.join(kept, F.col("block") == F.col("k_block")).select("token", "block", "weight")


def match_ranked(spark: SparkSession, path: str, query: str, n: int = 10) -> DataFrame:
    """The ``n`` documents that match ``query`` best: rank (from 1), key, score.  A document's score is the sum over the
    query's tokens, once each, of ln(1 + (N - df + 0.5) / (df + 0.5)) times its gain, rounded to six places; ties go to the
    smaller key.  A query without tokens, or of unknown ones, gives no rows."""
    path = path.rstrip("/")
    opened = open_blocks(spark, path, query, n).select(F.col("token").alias("o_token"), F.col("block").alias("o_block"), "weight")
    key_type = spark.read.parquet(f"{path}/totals").first()["key_type"]
    postings = _of_tokens(spark, f"{path}/postings", _POSTINGS.format(key_type), asked_tokens(query))
    hits = postings.join(opened, (F.col("token") == F.col("o_token")) & (F.col("block") == F.col("o_block")))
    scores = hits.groupBy("key").agg(F.sum(F.col("weight") * F.col("gain")).cast(SCALE).alias("score"))
    top = scores.orderBy(F.col("score").desc(), F.col("key")).limit(n)  # a top-k report
    ordered = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), "key"))).alias("hits"))  # n entries
    return (ordered.select(F.posexplode("hits").alias("at", "h"))
            .select((F.col("at") + 1).cast("long").alias("rank"), F.col("h.key").alias("key"), (-F.col("h.low")).cast("double").alias("score")))
