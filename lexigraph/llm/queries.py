"""The registered queries of the training-data operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, language_id, mixing, near_dedup, pii, quality, repeats, sharding, url_filter
from .common import table


def op3_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"))


def op4_suffix_index_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, sf_dir, "documents"), texts=False)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))


def op5_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op2_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.found(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op6_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encoded(table(spark, sf_dir, "documents"), tokenizer_path(), decoded=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_grace_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op9_bloom_cascade_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_histogram_sort_shards": op1_histogram_sort_shards,
    "op2_crf_pii": op2_crf_pii,
    "op3_bbit_minhash": op3_bbit_minhash,
    "op4_suffix_index_repeats": op4_suffix_index_repeats,
    "op5_line_frequency_quality": op5_line_frequency_quality,
    "op6_backtracking_bpe": op6_backtracking_bpe,
    "op7_grace_exact_dedup": op7_grace_exact_dedup,
    "op8_nearest_centroid_language": op8_nearest_centroid_language,
    "op9_bloom_cascade_urls": op9_bloom_cascade_urls,
    "op10_temperature_mixing": op10_temperature_mixing,
}

_BLOCKED = " OR ".join(f"host = '{h}' OR host LIKE '%.{h}'" for h in url_filter.BLOCKED_HOSTS)
_FITS = ", ".join(
    f"CASE WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}' END"
    for h, p, _ in sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))
)
_VERDICTS = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in url_filter.RULES)

ORACLE_SQL: dict[str, str] = {
    "op7_grace_exact_dedup": """
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op9_bloom_cascade_urls": f"""
        WITH u AS (
            SELECT page_id, strpos(coalesce(url, ''), '://') AS colon, coalesce(url, '') AS url FROM pages),
        p AS (
            SELECT page_id,
                   CASE WHEN colon > 0 THEN translate(regexp_extract(substr(url, colon + 3), '^[^/?#]*'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                   CASE WHEN colon > 0 THEN regexp_extract(substr(url, colon + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM u),
        r AS (SELECT *, coalesce({_FITS}) AS rule FROM p)
        SELECT page_id, host, path, rule,
               CASE rule {_VERDICTS} ELSE CASE WHEN {_BLOCKED} THEN 'block' ELSE 'allow' END END AS verdict
        FROM r""",
}
