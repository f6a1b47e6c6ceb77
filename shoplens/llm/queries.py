"""The registered queries of this package: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import chat, fingerprint, grid_order, license_scan, line_dedup, mixing, ngram_join, pieces, quality, ranked, repair, sharding, topk
from shoplens.llm.common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.neighbours(read(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents the classifier keeps, with their scores."""
    judged = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.filter("verdict.keep").select("row.doc_id", "verdict.score", F.col("verdict.posterior").alias("weak_posterior"), "verdict.keep")


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(read(spark, sf_dir, "documents"), n_shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(read(spark, sf_dir, "documents"), pieces.default_model())


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.conversation_digests(chat.format_chats(turns))


def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=50)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order.link_vectors(read(spark, sf_dir, "embeddings"), cosine=0.98)


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_topk_search, op3_quality, op4_fingerprint, op5_ngram_join, op6_sharding, op7_piece_encoding, op8_chat_format, op9_pfair_mixing, op10_line_dedup,
                            op11_ranked_search, op12_embedding_dedup, op13_structure_repair)
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE_SQL: dict[str, str] = {}

# Each turn is written as <|turn|>role<|body|>text<|end|> (23 characters besides role and text), with a backslash more
# for each control string inside.
_CONTROLS = r"[<\[]\\*(\|turn\|>|\|body\|>|\|end\|>|\|(image|audio|document):[0-9]+\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)"

ORACLE_SQL["op2_topk_search"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, a.q, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND (a.vec_id <> b.vec_id OR a.q <> b.q)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

ORACLE_SQL["op5_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END AS s FROM d
), x AS (
  SELECT r, len(s) AS n, unnest(s) AS shingle FROM s
), p AS (
  SELECT a.r AS a, b.r AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.r <> b.r
  GROUP BY a.r, b.r HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT r, doc_id AS m FROM s UNION SELECT p.b, reach.m FROM reach JOIN p ON p.a = reach.r
), c AS (
  SELECT r, min(m) AS component_id FROM reach GROUP BY r
), n AS (
  SELECT a AS r, count(*) AS links FROM p GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(links, 0) AS BIGINT) AS n_links FROM s JOIN c USING (r) LEFT JOIN n USING (r)
"""

ORACLE_SQL["op8_chat_format"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(23 + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROLS}')) + len(regexp_extract_all(text, '{_CONTROLS}'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    return f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}')"


ORACLE_SQL["op11_ranked_search"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT r, doc_id, unnest({_terms("text")}) AS term FROM d
), c AS (
  SELECT r, doc_id, term, count(*) AS tf FROM w GROUP BY ALL
), l AS (
  SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY r
), g AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM l
), q AS (
  SELECT DISTINCT item_id, unnest({_terms("text")}) AS term FROM benchmark
), f AS (
  SELECT c.term, CAST(floor(1000 * ln(CAST(2 * any_value(g.docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS wt
  FROM c, g WHERE c.term IN (SELECT term FROM q) GROUP BY c.term
), s AS (
  SELECT q.item_id, c.doc_id, CAST(sum(f.wt * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (50 + ((50 * l.n * g.docs) // g.terms))))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN c USING (term) JOIN l USING (r), g GROUP BY q.item_id, c.doc_id, c.r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""

ORACLE_SQL["op12_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
), e AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r WHERE list_cosine_similarity(a.x, b.x) >= 0.98
), reach AS (
  SELECT r, vec_id AS m FROM v UNION SELECT e.b, reach.m FROM reach JOIN e ON e.a = reach.r
), c AS (
  SELECT r, min(m) AS component_id FROM reach GROUP BY r
), n AS (
  SELECT a AS r, count(*) AS links FROM e GROUP BY a
)
SELECT vec_id, coalesce(n.links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN c USING (r) LEFT JOIN n USING (r)
"""

ORACLE_SQL["op10_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, trim(unnest(ls), ' ') AS line FROM d WHERE text IS NOT NULL
), w AS (
  SELECT *, len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) AS words FROM l
), c AS (
  SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS till FROM w WHERE words > 0
), b AS (
  SELECT *, till - words AS start FROM c
), runs AS (
  SELECT doc_id, list(line) OVER f AS run, list(pos) OVER f AS lines, sum(words) OVER f AS n FROM b
  WINDOW f AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 24 FOLLOWING)
  UNION ALL
  SELECT doc_id, list(line) OVER f, list(pos) OVER f, sum(words) OVER f FROM b
  WINDOW f AS (PARTITION BY doc_id ORDER BY till RANGE BETWEEN 24 PRECEDING AND CURRENT ROW)
), places AS (
  SELECT doc_id, lines, first_value(doc_id) OVER g AS first_id, first_value(lines[1]) OVER g AS first_line FROM runs WHERE n >= 25
  WINDOW g AS (PARTITION BY run ORDER BY doc_id, lines[1])
), gone AS (
  SELECT doc_id, list(DISTINCT pos) AS removed FROM (SELECT doc_id, unnest(lines) AS pos FROM places WHERE doc_id <> first_id OR lines[1] <> first_line) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(len(removed), 0) AS n_removed,
       CASE WHEN removed IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda x, i: NOT list_contains(removed, i - 1)), chr(10)) END AS text
FROM d LEFT JOIN gone USING (doc_id)
"""
