"""The operators applied to the given tables, and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.plans.registry import Registry

from .common import ship
from . import language_id, license_scan, mixing, oracles, order_minhash, packing, quality_rules, resampling, secrets, simhash, token_counts, token_files, warc, whitening

registry = Registry()

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public tokenizer's file lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registry.query()
def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.edited_likeness(table(spark, folder, "documents"))


@registry.query()
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


@registry.query(oracles.license_labels())
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


@registry.query(oracles.source_mix())
def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.words_taken(table(spark, folder, "documents"))


@registry.query()
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    spans = secrets.scanned(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.digest(F.col("spans"), *secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.digest(F.col("spans"), *secrets.KINDS).alias("spans"),
    )


@registry.query()
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), tokenizer_path())


@registry.query()
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


@registry.query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


@registry.query(
    """
    WITH hashed AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), first AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM hashed
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM first
    """
)
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@registry.query()
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


@registry.query(oracles.importance_resampling())
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@registry.query()
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@registry.query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))
