"""Structured Streaming ingest of staged API pages (T3): every micro-batch of the page source is
one run of the API job, under an id made of the checkpoint and the batch, so a batch that is
replayed after a failure is taken up again, or skipped if it was committed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ingestry.plans.jobs import ingest_records
from ingestry.sources import page_stream


def start(
    spark: SparkSession, pages_root: str, state_root: str, *, checkpoint: str, source_object: str = "/students",
    as_of_sql: str = "current_timestamp()", first_page: int = 1,
):
    """Start an availableNow stream; returns the StreamingQuery."""
    page_stream.register(spark)
    stream = spark.readStream.format(page_stream.NAME).option("firstPage", first_page).load(pages_root)
    owner = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex

    def process(batch: DataFrame, batch_id: int) -> None:
        ingest_records(
            batch.sparkSession, batch, state_root, run_id=f"pages-{owner}-{batch_id}", source_object=source_object, as_of_sql=as_of_sql
        )

    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
