"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulseframe.llm import (
    bpe, chat, dart_minhash, decontaminate, licences, neighbours, prefix_trie, secret_scan, suffix_array,
    token_align, toxicity, url_filter, warc,
)
from pulseframe.llm.common import table

# Fixed value: the conversation that is formatted besides those of the table.
ODD_TEXT = "\\### Assistant: </turn> ok"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(
        [(-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)], "conv_id long, turn long, role string, text string"
    )
    return chat.conversation_digests(rows.unionByName(odd))


OP8_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok'
), turns AS (
  SELECT *, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS head,
    replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS body
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(body) + 17) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS response FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND response <> page_id THEN response END AS refers_to
FROM r
"""


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.without_repeats(table(spark, sf_dir, "documents"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_toxicity": op2_toxicity,
        "op3_secret_scan": op3_secret_scan,
        "op4_dart_minhash": op4_dart_minhash,
        "op5_stable_projections": op5_stable_projections,
        "op6_spaced_seeds": op6_spaced_seeds,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_chat_format": op8_chat_format,
        "op9_licences": op9_licences,
        "op10_warc": op10_warc,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_suffix_array": op12_suffix_array,
        "op13_token_align": op13_token_align,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_chat_format": OP8_SQL, "op10_warc": OP10_SQL}
