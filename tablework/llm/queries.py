"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablework.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.simhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("row")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_dropped")


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_mixing_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.mixing import mixture

    return mixture(table(spark, sf_dir, "documents")).drop("row")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"))


@query
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.chat_format import format_conversations

    return format_conversations(table(spark, sf_dir, "conversations"))


# The prefix rule on rendered turns: one conversation is a snapshot of another when its text, turn numbers included, is a
# proper prefix of it.
SQL["op1_chat_format"] = """
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
turns AS (
  SELECT *, ROW_NUMBER() OVER w - 1 AS n, COUNT(*) OVER (PARTITION BY conv_id) AS n_turns,
    STRING_AGG(turn || '|' || role || '|' || text, '||') OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
ends AS (SELECT upto, MIN(conv_id) AS conv_id, COUNT(*) AS copies FROM turns WHERE n + 1 = n_turns GROUP BY upto),
kept AS (SELECT * FROM ends WHERE upto NOT IN (SELECT upto FROM turns WHERE n + 1 < n_turns))
SELECT t.conv_id, t.n // 2000 AS part, MAX(t.n_turns) AS n_turns, MAX(k.copies) AS copies,
  STRING_AGG('<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10), '' ORDER BY t.n) AS text
FROM turns t JOIN kept k USING (conv_id) GROUP BY ALL
"""


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.pii import pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents"), key="tablework")


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.url_filter import judged

    return judged(table(spark, sf_dir, "pages"))


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.packing import pack

    return pack(table(spark, sf_dir, "documents")).pieces.drop("row")


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablework.llm.prefix_trie import conversation_trie

    return conversation_trie(table(spark, sf_dir, "conversations"))


# Prefixes as joined texts, every node with its ancestors on the path of its smallest member; crc32 bit by bit.
SQL["op13_conversation_trie"] = """
WITH turns AS (
  SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) - 1 AS pos,
    STRLEN(COALESCE(role, '')) || ':' || COALESCE(role, '') || STRLEN(COALESCE(text, '')) || ':' || COALESCE(text, '') AS turn,
    STRLEN(COALESCE(text, '')) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, COUNT(*) AS own, conv_id - conv_id % 5 AS lender, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1))))) % 9 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.turn, t.n_bytes FROM convs c JOIN turns t ON t.conv_id = c.lender AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + LEAST(c.h, COALESCE(l.own, 0)), t.turn, t.n_bytes
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h LEFT JOIN convs l ON l.conv_id = c.lender),
prefixes AS (
  SELECT conv_id, pos + 1 AS depth, n_bytes, STRING_AGG(turn, '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS upto
  FROM rebuilt UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
path AS (
  SELECT conv_id, depth, n_bytes, MIN(conv_id) OVER same AS node, COUNT(*) OVER same AS n_convs, MAX(depth) OVER (PARTITION BY conv_id) AS last
  FROM prefixes WINDOW same AS (PARTITION BY depth, upto)),
nodes AS (
  SELECT p.node AS conv_id, p.depth, u.node AS parent_conv_id, p.n_convs, (p.n_convs - 1) * p.n_bytes AS saved
  FROM path p LEFT JOIN path u ON u.conv_id = p.conv_id AND u.depth = p.depth - 1 WHERE p.node = p.conv_id),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, COUNT(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, COALESCE(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (conv_id, depth)),
totals AS (
  SELECT p.node AS conv_id, p.depth, SUM((n.n_children = 0)::INT) AS n_leaves, SUM(n.saved) AS saved_tokens
  FROM full_nodes n JOIN path p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL),
ends AS (SELECT node AS conv_id, depth, STRING_AGG(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM path WHERE depth = last GROUP BY ALL)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(COALESCE(ids, '')) AS ends_sha256
FROM full_nodes JOIN totals USING (conv_id, depth) LEFT JOIN ends USING (conv_id, depth)
"""
