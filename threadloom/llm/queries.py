"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import bpe, chat, counts, decontaminate, langid, sharding, simhash, substrings, warc, winnow
from threadloom.sources.tables import spread


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(_read(spark, sf_dir, "conversations"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.report(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(_read(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(_read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(spark, _read(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(_read(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.report(_read(spark, sf_dir, "documents"))


_ALL = (op1_chat, op2_token_counts, op3_bpe, op4_decontaminate, op5_sharding, op6_substrings, op7_warc, op8_simhash, op9_langid, op10_winnow)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES: dict[str, str] = {
    "op1_chat": r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
sum(20 + length(role || text) + length(regexp_replace(role || text, '[^<\[]', '', 'g')))::BIGINT AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""",
    "op4_decontaminate": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT item, w, least(len(w), 8) AS n, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
h AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, win)), p AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM h) GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated FROM d LEFT JOIN p USING (doc_id) LEFT JOIN s USING (doc_id)""",
    "op7_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), q AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM q""",
}
