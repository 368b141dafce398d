"""The training-data queries, each applying its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontam, hard_negatives, html_text, langid, minhash, packing, sharding, simhash, token_counts, topk, url_filter
from .common import read_table, vocabulary

URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op2_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    said = "</s>[INST] ok [/INST]"
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], table.schema)
    windows = chat.format_windows(table.unionByName(extra), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return chat.digests(windows)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = sharding.shuffle_into_shards(read_table(spark, sf_dir, "documents"))
    return shuffled.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_lexical_packing": op2_lexical_packing,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_chat_format": op5_chat_format,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_html_text": op8_html_text,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_simhash": op11_simhash,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": r"""
        WITH cut AS (
          SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
          FROM pages),
        split AS (
          SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
        named AS (
          SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
          FROM split),
        judged AS (
          SELECT *, CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
          FROM named)
        SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged""",
    "op6_exact_top_k": """
        WITH v AS (
          SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT) FOR x IN embedding] AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
                 CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, d.v)]) AS BIGINT) AS score
          FROM v q JOIN v d ON q.vec_id <> d.vec_id
          WHERE q.vec_id % 20 = 0),
        ranked AS (
          SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
          FROM scored)
        SELECT * FROM ranked WHERE rank <= 20""",
    "op12_hard_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, d.vec_id AS vec_id, a.label = d.label AS same,
                 CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, d.v)]) AS BIGINT) AS score
          FROM v a JOIN v d ON a.vec_id <> d.vec_id
          WHERE a.vec_id % 100 = 0),
        positives AS (
          SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same) p
          WHERE place <= 5),
        mined AS (
          SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                 CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
          FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
          WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 10""",
}
