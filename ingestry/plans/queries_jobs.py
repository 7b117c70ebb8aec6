"""Driver queries that run whole jobs and streams: files are rendered from `events` into a
scratch folder, listed, claimed, parsed by byte ranges, merged and committed by the jobs
themselves, and the query returns what the committed state holds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.operators import dedupe as D
from ingestry.operators import quarantine as Q
from ingestry.plans import derived as X
from ingestry.plans.jobs import run_csv_job
from ingestry.plans.queries import _batch, ntz, query
from ingestry.plans.state import StateStore
from ingestry.sources import csv as CSV
from ingestry.sources import landing as LD

BODIES = 8  # large files, however many rows there are
SPLIT = 64 * 1024  # so that the files of the driver's sizes have several ranges
FIRST_OF_TASK = "(monotonically_increasing_id() & 8589934591) = 0"


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a temporary one on a local master without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='ingestry-')).rstrip('/')}/{uuid.uuid4().hex}"


def render_landing(spark: SparkSession, sf_dir: str) -> str:
    """The dirty records as a few large CSV files, in order; a row ends at its first null. Returns
    the folder."""
    fields = ", ".join(f"`{f}`" for f in S.CANONICAL_FIELDS)
    present = f"coalesce(nullif(array_position(transform(array({fields}), x -> x IS NULL), true), 0) - 1, {len(S.CANONICAL_FIELDS)})"
    values = (
        f"concat(slice(array({fields}), 1, CAST({present} AS INT)), "
        f"CASE WHEN {present} = {len(S.CANONICAL_FIELDS)} THEN coalesce(`{S.EXTRA_COLUMNS}`, array()) ELSE array() END)"
    )
    line = f"array_join(transform({values}, v -> concat('\"', replace(v, '\"', '\"\"'), '\"')), ',')"
    order = [S.FILE_ORDINAL, S.ROW_ORDINAL]
    rows = X.dirty_records(spark, sf_dir).repartitionByRange(BODIES, S.FILE_ORDINAL).sortWithinPartitions(*order)
    # the header's text is the name of the only column; nothing is quoted a second time
    text = rows.selectExpr(f"{line} AS `{','.join(S.CANONICAL_FIELDS)}`")
    root = f"{scratch(spark)}/landing"
    text.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(root)
    return root


def _ingested(spark: SparkSession, sf_dir: str) -> StateStore:
    root = render_landing(spark, sf_dir)
    state, processed = (f"{root.removesuffix('/landing')}/{name}" for name in ("state", "processed"))
    run_csv_job(spark, root, state, chunk_size=X.CHUNK_SIZE, as_of_sql=X.AS_OF_SQL, split=SPLIT, processed_root=processed)
    return StateStore(spark, state)


@query
def csv_job_target(spark, sf_dir):
    """The keyed table that a job over all files commits."""
    return _ingested(spark, sf_dir).target().select(
        "student_id", "first_name", "last_name", "grade_level", "school_id", "email", "enrollment_status",
        ntz("updated_at").alias("updated_at"), "guardian_contact", "source_system",
        ntz("ingested_at").alias("ingested_at"), ntz("last_written_at").alias("last_written_at"),
    )


@query
def stream_landing_target(spark, sf_dir):
    """The same table from a stream that finds the files, all in one micro-batch."""
    from ingestry.streaming import landing as STREAM

    root = render_landing(spark, sf_dir)
    state, checkpoint = (f"{root.removesuffix('/landing')}/{name}" for name in ("state", "checkpoint"))
    STREAM.start(spark, root, state, chunk_size=X.CHUNK_SIZE, checkpoint=checkpoint, as_of_sql=X.AS_OF_SQL).awaitTermination()
    return StateStore(spark, state).target().select("student_id", "first_name", "email", ntz("updated_at").alias("updated_at"))


@query
def csv_job_report(spark, sf_dir):
    """Rejects read back by reason, the ledger's counters over all files, and
    the files that the archiving left behind."""
    store = _ingested(spark, sf_dir)
    rejects = Q.read_back(spark, f"{store.root}/quarantine").groupBy("reason_code", "field").agg(F.count("*").alias("n"))
    runs = store.ledger().groupBy("status").agg(*[F.sum(c).alias(c) for c in ("rows_read", "rows_valid", "rows_quarantined", "rows_written")])
    counters = runs.unpivot(["status"], ["rows_read", "rows_valid", "rows_quarantined", "rows_written"], "counter", "n")
    moved = LD.list_objects(spark, store.root.removesuffix("state") + "processed").agg(F.lit(0).cast("long").alias("n"), F.min("size").alias("least"))
    return (
        rejects.selectExpr("'reject' AS kind", "reason_code AS name", "field", "n")
        .unionByName(counters.selectExpr("status AS kind", "counter AS name", "CAST(NULL AS STRING) AS field", "n"))
        .unionByName(moved.selectExpr("'archived' AS kind", "CASE WHEN least > 0 THEN 'whole' END AS name", "CAST(NULL AS STRING) AS field", "n"))
    )


@query
def csv_ranges(spark, sf_dir):
    """S3: the rows of the large files as parsed range by range, numbered through each file."""
    root = render_landing(spark, sf_dir)
    pieces = CSV.read_files(CSV.eligible_files(spark, root), split=SPLIT)
    rows = CSV.numbered(pieces)
    return rows.selectExpr(
        "_src['student_id'] AS student_id", "_src['updated_at'] AS updated_at", "_src['guardian_contact'] AS guardian_contact",
        f"array_join({S.EXTRA_COLUMNS}, '|') AS surplus", f"_source_line - {S.ROW_ORDINAL} AS lines_above",
    )


@query
def survivors_in_order(spark, sf_dir):
    """O2: survivors written in source order, and the place at which each is read back."""
    rows = _batch(spark, sf_dir).survivors.select(
        S.FILE_ORDINAL, S.CHUNK_INDEX, S.ROW_ORDINAL, F.col(S.SOURCE_OBJECT).alias("source_object"), F.col("_c_student_id").alias("student_id")
    )
    path = f"{scratch(spark)}/survivors"
    D.in_source_order(rows).write.parquet(path)
    back = spark.read.parquet(path).selectExpr("*", "_metadata.file_name AS part", "_metadata.row_index AS at")
    # one row a part
    before = back.groupBy("part").agg(F.count("*").alias("n")).selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS before")
    return back.join(before, "part").selectExpr("source_object", f"{S.ROW_ORDINAL} AS row_ordinal", "student_id", "before + at + 1 AS place")


@query
def stream_merge_actions(spark, sf_dir):
    """T5: three micro-batches through the keyed state of a stream."""
    from ingestry.streaming.latest_state import latest_actions

    rows = _batch(spark, sf_dir).students.selectExpr(
        "student_id", "updated_at", f"`{S.FILE_ORDINAL}` * 1000 + `{S.ROW_ORDINAL}` AS o", f"`{S.FILE_ORDINAL}` % 3 AS g"
    )
    root = scratch(spark)
    rows.write.partitionBy("g").parquet(f"{root}/rows")  # the cascade runs once, for all three
    kept = spark.read.schema(rows.schema).parquet(f"{root}/rows")
    stream = spark.readStream.schema("student_id string, updated_at timestamp, o long")
    found = latest_actions(stream.parquet(f"{root}/in/*"), order="o")
    for g in range(3):  # the stream takes all files there are as one micro-batch, and resumes behind them
        kept.filter(f"g = {g}").drop("g").write.parquet(f"{root}/in/g={g}")
        run = found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        run.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    done: DataFrame = spark.read.schema(found.schema).parquet(f"{root}/out")
    return done.select("student_id", ntz("updated_at").alias("updated_at"), "place", "action", "submitted")
