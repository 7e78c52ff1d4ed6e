"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm import collocations, decontaminate, fingerprints, inner_products, mixing, pii, secret_scan, simhash, spelling, token_counts, token_files, toxicity, warc

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    rows = warc.roundtrip(spark, table(spark, folder, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.roundtrip(spark, table(spark, folder, "documents"), tokenizer_path())


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, folder, "documents"))
    return rows.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.personal_data(table(spark, folder, "documents"))
    # the text as sanitised, where that changed it
    return rows.withColumn("sanitised_sha256", F.sha2(F.col("sanitised").cast("binary"), 256)).drop("sanitised")


def op8_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path())


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(table(spark, folder, "documents"))


def op11_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    return inner_products.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


OP1_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest, strlen(coalesce(html, ''))::BIGINT AS bytes FROM pages
), grouped AS (
  SELECT *, CASE WHEN bytes >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS largest FROM payloads
)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM grouped
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc, op2_token_files, op3_simhash, op4_fingerprints, op5_toxicity, op6_decontaminate, op7_personal_data, op8_mix, op9_token_counts, op10_secrets,
        op11_inner_products, op12_spelling_variants, op13_collocations,
    )
}

ORACLE: dict[str, str] = {"op1_warc": OP1_SQL, "op8_mix": mixing.SQL.format(table="documents"), "op11_inner_products": inner_products.SQL, "op12_spelling_variants": spelling.SQL, "op13_collocations": collocations.SQL}
