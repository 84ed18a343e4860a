"""Registered queries of this folder, on whole tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roomtide.llm import (
    context_tree, html_text, minhash, packing, quality, repair, simhash, snapshots, spaced_seeds, spelling, suffix_dedup, token_files, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.collapse_and_render(read(spark, sf_dir, "conversations"))


SQL["op1_snapshot_collapse"] = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), listed AS (
  SELECT conv_id, count(*) AS n_turns, list(role || chr(0) || text ORDER BY turn NULLS FIRST, role, md5(text)) AS said,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text)) AS text
  FROM turns GROUP BY conv_id
), inner_parts AS (
  SELECT DISTINCT said[1:k] AS said FROM (SELECT said, unnest(range(1, n_turns)) AS k FROM listed)
), heads AS (
  SELECT said, min(conv_id) AS conv_id, count(*) AS n_copies FROM listed GROUP BY said
)
SELECT h.conv_id, l.n_turns, h.n_copies, l.text
FROM heads h JOIN listed l ON h.conv_id IS NOT DISTINCT FROM l.conv_id
WHERE h.said NOT IN (SELECT said FROM inner_parts)
"""


@query
def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def packing_sql(table: str, settings: packing.Settings = packing.Settings()) -> str:
    """The dynamic program step by step; ties go to the lower boundary, as in the operator."""
    m, budget = settings.max_length, settings.budget
    steps = ""
    for k in range(1, settings.buckets):
        steps += f"""
, best{k} AS MATERIALIZED (
  SELECT n.j, least(any_value(p0.cost), min(p.cost + n.len * (n.rows - i.rows) - (n.tokens - i.tokens))) AS cost,
    arg_min(p.j, (p.cost + n.len * (n.rows - i.rows) - (n.tokens - i.tokens), p.j)) AS cut
  FROM sums n JOIN best{k - 1} p0 ON p0.j = n.j JOIN best{k - 1} p ON p.j < n.j JOIN (SELECT j, rows, tokens FROM sums UNION ALL SELECT 0, 0, 0) i ON i.j = p.j
  WHERE n.j > 0 GROUP BY n.j
  UNION ALL SELECT 0, 0, 0)"""
    last = settings.buckets - 1
    walk = f", end{last} AS (SELECT max(j) AS j FROM sums)"
    for k in range(last, 0, -1):
        walk += f", end{k - 1} AS (SELECT b.cut AS j FROM end{k} e JOIN best{k} b ON b.j = e.j)"
    ends = " UNION ".join(f"SELECT len FROM sums JOIN end{k} e USING (j)" for k in range(settings.buckets))
    return f"""
WITH sized AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) + 1 AS n FROM {table}),
pieces AS (
  SELECT doc_id, piece, least({m}, n - piece * {m}) AS length
  FROM (SELECT doc_id, n, unnest(range(0, (n - 1) // {m} + 1)) AS piece FROM sized)
), histogram AS (SELECT length AS len, count(*) AS n FROM pieces GROUP BY length),
sums AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY len) AS j, len, CAST(sum(n) OVER (ORDER BY len) AS BIGINT) AS rows,
    CAST(sum(n * len) OVER (ORDER BY len) AS BIGINT) AS tokens FROM histogram
), best0 AS MATERIALIZED (SELECT j, len * rows - tokens AS cost FROM sums UNION ALL SELECT 0, 0){steps}{walk},
ends AS ({ends}),
placed AS (
  SELECT p.doc_id, p.piece, p.length, (SELECT min(len) FROM ends e WHERE e.len >= p.length) AS padded,
    md5(coalesce(CAST(p.doc_id AS VARCHAR), '') || ':' || CAST(p.piece AS VARCHAR)) AS order_key FROM pieces p
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY padded ORDER BY order_key, doc_id, piece) - 1 AS rank FROM placed
)
SELECT doc_id, piece, length, padded, rank // ({budget} // padded) AS batch, rank % ({budget} // padded) AS slot FROM ranked
"""


SQL["op3_length_buckets"] = packing_sql("documents")


@query
def op4_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_and_read(spark, read(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


@query
def op7_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


@query
def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_index(spark, read(spark, sf_dir, "pages"))


SQL["op2_capture_index"] = r"""
WITH rows AS (
  SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT *, array_to_string([
    substr('0000000100100011010001010110011110001001101010111100110111101111', 1 + 4 * (strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4)
    for i in range(1, 41)], '') AS bin
  FROM rows
), named AS (
  SELECT page_id, payload_bytes, url, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bin, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(bin, 5 * i + 2, 1) AS INTEGER)
      + 4 * CAST(substr(bin, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substr(bin, 5 * i + 4, 1) AS INTEGER) + CAST(substr(bin, 5 * i + 5, 1) AS INTEGER), 1)
    for i in range(0, 32)], '') AS payload_digest
  FROM coded
), last_of AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest,
    regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)', 1) AS host,
    regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)', 2) AS rest FROM named
), keyed AS (
  SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS NOT DISTINCT FROM newest THEN NULL ELSE newest END AS refers_to,
    CASE WHEN regexp_matches(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN
      array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^www\.', ''), '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END
    ELSE url END AS url_key
  FROM last_of
)
SELECT page_id, payload_bytes, payload_digest, record_type, refers_to, url_key,
  row_number() OVER (ORDER BY url_key, page_id % 31622400, page_id) - 1 AS index_rank FROM keyed
"""


@query
def op9_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints_and_classes(read(spark, sf_dir, "documents"))


@query
def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_documents(read(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damage_and_repair(read(spark, sf_dir, "conversations"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"))


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, read(spark, sf_dir, "documents"))
