"""Quarantine sink and read-back.

Layout `{root}/source_system=../run_id=../from_chunk=../part-*.json` (JSON Lines, sorted keys
per record; the chunk is one of them). `from_chunk` is the last chunk committed when the
attempt began: an attempt that repeats another replaces its folder (dynamic partition
overwrite), one that resumes behind committed chunks has a folder of its own. So there are as
many folders as attempts, not as chunks, and each reject is there once. An attempt without
rejects writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.functions.clean import sql_str

CHUNKS_A_TASK = 200
ROWS_A_FILE = 1_000_000


def as_json_lines(quarantine: DataFrame, *, run_id_col: str, correlation_id: str) -> DataFrame:
    """One JSON object per reject with its keys in sorted order."""
    return quarantine.selectExpr(
        "source_system",
        f"CAST(`{run_id_col}` AS STRING) AS run_id",
        "from_chunk",
        "chunk_index",
        f"to_json(named_struct('chunk_index', chunk_index, "
        f"'correlation_id', {sql_str(correlation_id)}, 'detail', detail, 'field', field, "
        "'reason_code', reason_code, 'record', parse_json(record), "
        "'source_object', source_object, 'source_system', source_system), "
        "map('ignoreNullFields', 'false')) AS value",
    )


def write(quarantine: DataFrame, root: str, *, run_id_col: str, correlation_id: str) -> None:
    """K1: overwrite only the (source_system, run_id, from_chunk) partitions present. A run's
    rejects are spread over tasks by stretches of chunks."""
    (
        as_json_lines(quarantine, run_id_col=run_id_col, correlation_id=correlation_id)
        .repartition("run_id", F.expr(f"chunk_index div {CHUNKS_A_TASK}"))
        .drop("chunk_index")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_A_FILE)
        .partitionBy("source_system", "run_id", "from_chunk")
        .text(root)
    )


def read_back(spark, root: str) -> DataFrame:
    """Every quarantined record across runs, with its run and chunk."""
    return spark.read.option("basePath", root).text(root).selectExpr(
        "source_system", "run_id",
        "CAST(get_json_object(value, '$.chunk_index') AS BIGINT) AS chunk_index",
        "get_json_object(value, '$.reason_code') AS reason_code",
        "get_json_object(value, '$.detail') AS detail",
        "get_json_object(value, '$.field') AS field",
        "get_json_object(value, '$.record') AS record",
    )


def reason_counts(quarantine: DataFrame) -> DataFrame:
    """A3: rejects per reason code."""
    return quarantine.groupBy("reason_code").agg(F.count(F.lit(1)).alias("n"))
