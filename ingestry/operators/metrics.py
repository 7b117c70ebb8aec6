"""Run summaries and watermark candidates.

All counters come from ONE aggregation over a tagged union of the batch's row
sets (read / quarantined / merge actions), so a summary costs one shuffle keyed
by run, with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def tagged_rows(records: DataFrame, quarantine: DataFrame, actions: DataFrame, *, run: str, chunk: str) -> DataFrame:
    """Union of records (read), quarantine rows and per-survivor merge actions."""
    r = records.selectExpr(
        f"`{run}` AS _run", f"`{chunk}` AS _chunk", "1 AS _read", "0 AS _q", "0 AS _valid",
        "CAST(NULL AS STRING) AS _action", "CAST(NULL AS TIMESTAMP) AS _ts",
    )
    q = quarantine.selectExpr(
        "source_object AS _run", "chunk_index AS _chunk", "0 AS _read", "1 AS _q", "0 AS _valid",
        "CAST(NULL AS STRING) AS _action", "CAST(NULL AS TIMESTAMP) AS _ts",
    )
    a = actions.selectExpr(
        f"`{run}` AS _run", f"`{chunk}` AS _chunk", "0 AS _read", "0 AS _q", "1 AS _valid",
        "action AS _action", "updated_at AS _ts",
    )
    return r.unionByName(q).unionByName(a)


def tagged_from_marked(marked: DataFrame, actions: DataFrame, *, run: str, chunk: str, tf_sql: str) -> DataFrame:
    """Same tagged rows from ONE pass over the marked batch: every row was read; a
    row is quarantined if a rule failed, it lost a duplicate, or the transform
    guard fired (the union of the three quarantine branches)."""
    q = f"reason_code IS NOT NULL OR _kept_at IS NOT NULL OR ({tf_sql}) IS NOT NULL"
    m = marked.selectExpr(
        f"`{run}` AS _run", f"`{chunk}` AS _chunk", "1 AS _read", f"CASE WHEN {q} THEN 1 ELSE 0 END AS _q",
        "0 AS _valid", "CAST(NULL AS STRING) AS _action", "CAST(NULL AS TIMESTAMP) AS _ts",
    )
    a = actions.selectExpr(
        f"`{run}` AS _run", f"`{chunk}` AS _chunk", "0 AS _read", "0 AS _q", "1 AS _valid",
        "action AS _action", "updated_at AS _ts",
    )
    return m.unionByName(a)


def run_summary(tagged: DataFrame) -> DataFrame:
    """A1: per run chunks, read, valid, quarantined, inserted, updated, skipped, max_updated_at."""
    return tagged.groupBy(F.col("_run").alias("source_object")).agg(
        F.max("_chunk").alias("chunks"),
        F.sum("_read").cast("bigint").alias("read"),
        F.sum("_valid").cast("bigint").alias("valid"),
        F.sum("_q").cast("bigint").alias("quarantined"),
        F.count_if(F.col("_action") == "inserted").alias("inserted"),
        F.count_if(F.col("_action") == "updated").alias("updated"),
        F.count_if(F.col("_action") == "skipped").alias("skipped"),
        F.max("_ts").alias("max_updated_at"),
    )


def per_chunk_counts(tagged: DataFrame) -> DataFrame:
    """Input of ledger.progress: read/valid/quarantined/written per (run, chunk)."""
    return tagged.groupBy("_run", "_chunk").agg(
        F.sum("_read").cast("bigint").alias("read"),
        F.sum("_valid").cast("bigint").alias("valid"),
        F.sum("_q").cast("bigint").alias("quarantined"),
        F.count_if(F.col("_action").isin("inserted", "updated")).alias("written"),
    )


def watermark_candidates(valid_students: DataFrame, *, key: str) -> DataFrame:
    """A4: freshest updated_at over VALID rows (merge-skipped rows included)."""
    return valid_students.groupBy(F.col(key).alias("source")).agg(F.max("updated_at").alias("watermark"))


def job_totals(summaries: DataFrame) -> DataFrame:
    """Rows written over a job (inserted + updated) and files processed."""
    return summaries.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum(F.col("inserted") + F.col("updated")), F.lit(0)).cast("bigint").alias("rows_written"),
    )
