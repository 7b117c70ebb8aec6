"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Between stages the rows are written to the shared folder and reread.

A null text is rejected by the first stage like an empty one. Extra columns of documents,
whatever their names, pass through all but the last stage. Stages that drop documents tell
them apart by id and text, so rows without an id are judged by their own text; of rows that
repeat both, the near-duplicate stage keeps one. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestry.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from ingestry.llm.common import documents, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, rejected documents go."""
    return quality_rules.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; a document that was nothing else goes too."""
    return line_dedup.dedup(docs).filter(F.length("text") > 0)


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row whole, and its key: 128 bits of its id and text."""
    key = F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "doc_id", "text").alias("b"))
    return docs.select(F.struct("*").alias("_row"), key.alias("_key"))


def _unkeyed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("_row")[c].alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    rows = _keyed(docs)
    # smallest first: rows with an id, by id, then by key
    order = F.struct(F.col("_row.doc_id").isNull().alias("n"), F.col("_row.doc_id").alias("id"), "_key")
    found = simhash.near_duplicates(
        rows.select(order.alias("place"), F.col("_row.text").alias("text")),
        shingle=simhash.SHINGLE,
        max_bits=simhash.MAX_BITS,
        id_col="place",
    )
    kept = found.select(F.col("component_id._key").alias("_key")).distinct()
    return _unkeyed(rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows = _keyed(docs)
    found = decontaminate.contaminated(
        rows.select("_key", F.col("_row.text").alias("text")),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
        id_col="_key",
    )
    return _unkeyed(rows.join(found.select("_key").distinct(), "_key", "left_anti"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the hash of the bytes that the ids decode to."""
    import public_tokenizers

    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

# SimHash fingerprints and BPE merges have no SQL form; tests/llm holds run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
