"""One registered query per corpus operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestry.llm import (
    bpe,
    conversations,
    decontaminate,
    fingerprints,
    licenses,
    line_dedup,
    pii,
    quality_rules,
    sharding,
    simhash,
    substrings,
    toxicity,
    whitening,
)
from ingestry.llm.common import documents


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(documents(spark, sf_dir), length=400, keep="none")
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(documents(spark, sf_dir), with_counts=True)
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", "text")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir)).select("doc_id", "slot", "shard")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = bpe.encode_decode(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(documents(spark, sf_dir)).drop("cleaned")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("detections")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_suffix_array_dedup,
        op3_toxicity,
        op4_line_dedup,
        op5_sharding,
        op6_byte_bpe,
        op7_decontamination,
        op8_pii,
        op9_quality_rules,
        op10_license_scan,
        op11_conversation_repair,
        op12_embedding_whitening,
        op13_document_fingerprints,
    )
}
