"""Structured Streaming landing ingest.

The stream only discovers files (names, sizes and times below the landing root, subfolders
included); every micro-batch hands its listing to the batch job, so headers, line endings,
surplus values, versions, ledger and summaries are treated in one way. A micro-batch that
is replayed after a failure resumes its own claims, and what it had committed is skipped.

The file source doesn't see a rewritten file at a path it has consumed; the scheduled batch
job does, by its version in the ledger.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ingestry import schema as S
from ingestry.plans.jobs import ingest_files
from ingestry.sources.landing import described

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def start(
    spark: SparkSession,
    landing_root: str,
    state_root: str,
    *,
    chunk_size: int = S.DEFAULT_CHUNK_SIZE,
    checkpoint: str,
    as_of_sql: str = "current_timestamp()",
    max_files_per_trigger: int = 1000,
    processed_root: str | None = None,
):
    """Start an availableNow stream; returns the StreamingQuery (call awaitTermination).

    Files that fail are recorded in the ledger and don't stop the stream."""
    stream = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing_root)
        .select("path", "length", "modificationTime")
    )
    owner = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex

    def process(batch: DataFrame, batch_id: int) -> None:
        ingest_files(
            batch.sparkSession, described(batch, landing_root), state_root, chunk_size=chunk_size, as_of_sql=as_of_sql,
            correlation_id=f"stream-{owner}-{batch_id}", processed_root=processed_root, raise_on_failure=False,
        )

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
