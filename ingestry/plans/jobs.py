"""End-to-end batch jobs over a state folder (shared storage).

Layout under `state_root` (all written by Spark, readable by any reader):
  commits/, target/, ledger/, checkpoints/   the versioned state (`plans.state`)
  quarantine/             JSON Lines of rejects (K1)
  archive_failures/       files that could not be moved after their commit (K5)
  staging/<run>/          what one job read and derived, each written once (cuts lineage)

Order of a run: claim (`running` rows, one commit) -> read -> quarantine -> one commit of
merged buckets, progress, ends (`completed` or `failed`) and watermark. A claim is decided on
the ledger version that it is committed after, so two jobs never hold one file; a merge on
buckets that others replaced meanwhile is computed again. A crash between the steps only
repeats work on the next run. A file that fails, fails alone: the others complete, its own
whole chunks before the fault are kept, and the job raises at its end, naming it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.functions import payload as P
from ingestry.functions.clean import sql_str, timestamp_sql
from ingestry.operators import core
from ingestry.operators import ledger as L
from ingestry.operators import metrics as M
from ingestry.operators import quarantine as Q
from ingestry.plans.state import Change, Head, StateStore, beside
from ingestry.plans.state import staged as _staged
from ingestry.session import ensure_session
from ingestry.sources import csv as CSV

CLAIMED, PROGRESS, ENDED = 0, 1, 2
OTHER_BYTES = "the source object holds other bytes than when its first chunks were committed"
SHOWN_FAILURES = 20  # names in an error message; the ledger has them all

SUMMARY_SCHEMA = (
    "source_object string, chunks long, read long, valid long, quarantined long, inserted long, "
    "updated long, skipped long, max_updated_at timestamp, run_status string, error string"
)


class FilesFailed(RuntimeError):
    """Some files failed; the others are committed. `summaries` has a row for every file."""

    def __init__(self, message: str, summaries: DataFrame | None = None) -> None:
        super().__init__(message)
        self.summaries = summaries


class UnsafePages(RuntimeError):
    """The staged pages cannot be paged through safely; nothing was committed."""


def _numbered(df: DataFrame, by: str, name: str, path: str) -> DataFrame:
    """`df`, staged, with ordinals from 1 in the order of `by`: sorted by ranges, numbered in
    each task, and moved on by the sizes of the ranges before, one row for each of them."""
    at, bits = "_at", 33  # monotonically_increasing_id keeps a task's own count in its low bits
    placed = df.repartitionByRange(by).sortWithinPartitions(by).withColumn(at, F.monotonically_increasing_id())
    placed = _staged(placed, path).withColumn("_range", F.shiftright(at, bits))
    before = placed.groupBy("_range").agg(F.count("*").alias("_n")).selectExpr(
        "_range", "coalesce(sum(_n) OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before"
    )
    own = f"_before + ({at} & {(1 << bits) - 1}) + 1 AS `{name}`"
    return placed.join(before, "_range").selectExpr(*[f"`{c}`" for c in df.columns], own)


def _event(run: DataFrame, phase: int, status: str, as_of_sql: str, correlation: str, **values: str) -> DataFrame:
    """Ledger events for claimed runs; `values` override a column's SQL."""
    sql = {
        "run_id": "run", "attempt": "attempt", "phase": str(phase), "source": "source",
        "source_object_id": "source_object_id", "source_version": "source_version",
        "correlation_id": sql_str(correlation), "status": status, "last_chunk": "CAST(resume_from AS BIGINT)",
        "rows_read": "p_read", "rows_valid": "p_valid", "rows_quarantined": "p_quarantined", "rows_written": "p_written",
        "error": "CAST(NULL AS STRING)", "started_at": as_of_sql, "completed_at": "CAST(NULL AS TIMESTAMP)",
        "content_digest": "p_digest",
    } | values
    return run.selectExpr(*[f"{e} AS {c}" for c, e in sql.items()])


def _claim(store: StateStore, wanted: DataFrame, stage: str, *, as_of_sql: str, stale_after_seconds: int, correlation: str) -> DataFrame | None:
    """J3 + K3: the runs this job takes, recorded as `running` before any work on them. The
    decision and its record are one commit: if others claimed meanwhile, it is made again."""
    counters = ("rows_read", "rows_valid", "rows_quarantined", "rows_written")
    held: list[DataFrame] = []

    def decide(head: Head) -> Change | None:
        decided = L.claim_decisions(
            wanted, store.ledger(head), as_of_sql=as_of_sql, stale_after_seconds=stale_after_seconds,
            owner=correlation, carry=("correlation_id", "attempt", "content_digest", *counters),
        )
        claims = decided.filter(f"decision <> '{L.SKIP}'").selectExpr(
            "*", "coalesce(run_id, xxhash64(source, source_object_id, source_version)) AS run",
        ).selectExpr(
            *wanted.columns, "run", "CAST(resume_from AS BIGINT) AS resume_from", "coalesce(attempt, 0) + 1 AS attempt_",
            "content_digest AS p_digest",
            *[f"coalesce({c}, 0) AS p_{c.removeprefix('rows_')}" for c in counters],
        ).withColumnRenamed("attempt_", "attempt")
        held.append(_staged(claims, f"{stage}/claims-{len(held)}"))
        if not held[-1].limit(1).count():
            return None
        change = store.events(head, _event(held[-1], CLAIMED, "'running'", as_of_sql, correlation))
        change.read_ledger = True
        return change

    return held[-1] if store.commit(decide) else None


def _commit(
    store: StateStore, batch: core.Batch, claims: DataFrame, errors: DataFrame, stage: str, *,
    name: str, as_of_sql: str, correlation: str, n_claims: int, watermark_of: str | None = None,
) -> DataFrame:
    """Quarantine, then one commit: merged buckets, progress per chunk, the end of every claimed
    run and, for `watermark_of`, the source's watermark. `errors` (run, error). Returns the
    tagged rows of the merge that was committed. `name`: the claims' source object."""
    # a few large files would else gather their rejects in as many tasks
    runs = beside(n_claims)(claims.selectExpr(f"{name} AS source_object", "run", "resume_from AS from_chunk"))
    Q.write(batch.quarantine.join(runs, "source_object"), f"{store.root}/quarantine", run_id_col="run", correlation_id=correlation)
    merged: list[DataFrame] = []

    def build(head: Head) -> Change:
        # Chunk after chunk within a file, file after file by name.
        actions, change = store.merge(
            head, batch.students, f"{stage}/merge-{len(merged)}", as_of_sql=as_of_sql, seq=(S.FILE_ORDINAL, S.CHUNK_INDEX)
        )
        merged.append(M.tagged_from_marked(
            batch.marked, actions, run=S.SOURCE_OBJECT, chunk=S.CHUNK_INDEX, tf_sql=P.transform_failure_sql()
        ))
        events = _ends(claims, merged[-1], errors, as_of_sql=as_of_sql, correlation=correlation, name=name)
        recorded = store.events(head, events)
        change.ledger, change.drops = recorded.ledger, recorded.drops
        if watermark_of:
            # null (no valid row) doesn't advance it
            newest = f"timestamp_micros({batch.observed['newest']})" if batch.observed["newest"] is not None else "CAST(NULL AS TIMESTAMP)"
            candidate = store.spark.range(1).selectExpr(f"{sql_str(watermark_of)} AS source", f"{newest} AS watermark")
            change.checkpoints = store.watermarks(head, candidate, as_of_sql=as_of_sql)
        return change

    store.commit(build)
    return merged[-1]


def _ends(claims: DataFrame, tagged: DataFrame, errors: DataFrame, *, as_of_sql: str, correlation: str, name: str) -> DataFrame:
    """Ledger events: progress per chunk, and the end of every claimed run."""
    counters = ("read", "valid", "quarantined", "written")
    per_chunk = M.per_chunk_counts(tagged)
    prog = L.progress(per_chunk, run_col="_run", chunk_col="_chunk").withColumnRenamed("_run", name)
    counts = {f"rows_{c}": f"p_{c} + rows_{c}" for c in counters}
    steps = _event(claims.join(prog, name), PROGRESS, "'running'", as_of_sql, correlation, last_chunk="last_chunk", **counts)
    totals = per_chunk.groupBy(F.col("_run").alias(name)).agg(
        F.max("_chunk").alias("last_chunk"), *[F.sum(c).alias(f"rows_{c}") for c in counters]
    )
    ended = claims.join(totals, name, "left").join(errors, "run", "left")
    same = {f"rows_{c}": f"p_{c} + coalesce(rows_{c}, 0)" for c in counters}
    return steps.unionByName(
        _event(
            ended, ENDED, "CASE WHEN error IS NULL THEN 'completed' ELSE 'failed' END", as_of_sql, correlation,
            last_chunk="coalesce(last_chunk, resume_from, 0)", error=L.fail_event_sql("error"), completed_at=as_of_sql, **same,
        )
    )


def run_csv_job(
    spark: SparkSession,
    landing_root: str,
    state_root: str,
    *,
    chunk_size: int = S.DEFAULT_CHUNK_SIZE,
    as_of_sql: str = "current_timestamp()",
    correlation_id: str | None = None,
    stale_after_seconds: int = 3600,
    processed_root: str | None = None,
    raise_on_failure: bool = True,
    split: int | None = None,
) -> DataFrame:
    """Scan landing, claim new, failed and stale file versions, ingest, merge, record.

    Returns one summary row per processed file, those without rows included. If files
    failed, the others still complete (T7) and FilesFailed names the failed ones, unless
    `raise_on_failure` is off. With `processed_root`, completed unchanged files are then
    archived (K5).
    """
    return ingest_files(
        spark, CSV.eligible_files(spark, landing_root), state_root, chunk_size=chunk_size, as_of_sql=as_of_sql,
        correlation_id=correlation_id, stale_after_seconds=stale_after_seconds, processed_root=processed_root,
        raise_on_failure=raise_on_failure, split=split,
    )


def ingest_files(
    spark: SparkSession,
    listing: DataFrame,
    state_root: str,
    *,
    chunk_size: int = S.DEFAULT_CHUNK_SIZE,
    as_of_sql: str = "current_timestamp()",
    correlation_id: str | None = None,
    stale_after_seconds: int = 3600,
    processed_root: str | None = None,
    raise_on_failure: bool = True,
    split: int | None = None,
) -> DataFrame:
    """`run_csv_job` over a given listing (`path`, `name`, `version`)."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    ensure_session(spark)
    store = StateStore(spark, state_root)
    run = uuid.uuid4().hex
    correlation = correlation_id or run
    stage = f"{store.root}/staging/{run}"
    wanted = listing.selectExpr(
        "path", "name", "version", "'csv' AS source", "name AS source_object_id",
        f"{L.source_version_sql('version', str(chunk_size))} AS source_version",
    )
    claims = _claim(
        store, wanted, stage, as_of_sql=as_of_sql, stale_after_seconds=stale_after_seconds, correlation=correlation
    )
    if claims is None:
        return spark.createDataFrame([], SUMMARY_SCHEMA)

    # The only read of the landing files; everything after reads the staged rows.
    totals = Observation()
    read = CSV.read_files(claims, split=split).observe(totals, F.count(S.ROW_ORDINAL).alias("kept"), F.sum("_rows").alias("read"))
    pieces = _staged(read, f"{stage}/rows")
    # Files are compared one by one only if rows read and rows kept differ over all of them.
    lost, seen = "CASE WHEN _rows IS NULL THEN 'rows read and rows kept differ' END", None
    if totals.get["kept"] != (totals.get["read"] or 0):
        lost = "CASE WHEN _rows IS NULL OR _rows <> coalesce(_seen, 0) THEN 'rows read and rows kept differ' END"
        seen = pieces.filter(f"{S.ROW_ORDINAL} IS NOT NULL").groupBy("path").agg(F.count("*").alias("_seen"))
    other = (
        "CASE WHEN resume_from > 0 AND split(p_digest, ':')[0] = split(_digest, ':')[0] AND p_digest <> _digest "
        f"THEN '{OTHER_BYTES}' END"
    )
    # of a file that fails the whole chunks before the fault count, of an altered one none
    files = claims.join(CSV.closings(pieces, split=split), "path", "left")
    files = (files.join(seen, "path", "left") if seen is not None else files).selectExpr(
        "path", "name", "version", "run", "resume_from", "_digest", f"coalesce({other}, _error, {lost}) AS error",
        f"CASE WHEN coalesce({other}, {lost}) IS NOT NULL THEN 0 WHEN _error IS NULL THEN _rows "
        f"ELSE floor(_usable / {chunk_size}) * {chunk_size} END AS usable",
    )
    files = _numbered(files, "name", S.FILE_ORDINAL, f"{stage}/files")
    data = CSV.numbered(pieces)
    n_claims = claims.count()
    placed = files.selectExpr("path", f"name AS {S.SOURCE_OBJECT}", S.FILE_ORDINAL, "resume_from", "usable")
    data = data.join(beside(n_claims)(placed), "path")
    data = CSV.assign_chunks(CSV.with_fields(data.filter(f"{S.ROW_ORDINAL} <= usable")), chunk_size=chunk_size)
    data = data.filter(f"{S.CHUNK_INDEX} > resume_from").drop("path", "resume_from", "usable")
    batch = core.Batch(
        data, as_of=as_of_sql, payload_sql=P.MAP_PAYLOAD_SQL, missing_sql=P.MAP_MISSING_SQL
    ).staged(f"{stage}/marked")
    errors = files.filter("error IS NOT NULL").select("run", "error")
    # what the next attempt must find: the bytes of this one, or of the one that it resumed
    kept = files.selectExpr("run AS _run", "_digest", f"coalesce(error = '{OTHER_BYTES}', false) AS _other")
    claims = claims.join(kept, F.col("run") == F.col("_run"), "left").withColumn(
        "p_digest", F.expr("CASE WHEN _other THEN p_digest ELSE coalesce(_digest, p_digest) END")
    ).drop("_run", "_digest", "_other")
    tagged = _commit(store, batch, claims, errors, stage, name="name", as_of_sql=as_of_sql, correlation=correlation, n_claims=n_claims)
    summaries = files.selectExpr(
        "name AS source_object", "CASE WHEN error IS NULL THEN 'completed' ELSE 'failed' END AS run_status", "error"
    ).join(M.run_summary(tagged), "source_object", "left")
    summaries = _staged(
        summaries.fillna(0, ["chunks", "read", "valid", "quarantined", "inserted", "updated", "skipped"]).select(
            *[F.col(c.split()[0]) for c in SUMMARY_SCHEMA.split(", ")]
        ),
        f"{stage}/summaries",
    )
    if processed_root:
        _archive(store, files.filter("error IS NULL"), processed_root, stage, as_of_sql)
    failed = errors.count()
    if failed and raise_on_failure:
        names = files.filter("error IS NOT NULL").orderBy("name").limit(SHOWN_FAILURES).collect()
        more = f" and {failed - len(names)} more" if failed > len(names) else ""
        raise FilesFailed(f"{failed} CSV file(s) failed: {', '.join(r['name'] for r in names)}{more}", summaries)
    return summaries


def _archive(store: StateStore, done: DataFrame, processed_root: str, stage: str, as_of_sql: str) -> None:
    """K5 after the commit; files that stay behind are listed in `archive_failures`."""
    from ingestry.sources.landing import archive

    moved = _staged(archive(done, processed_root), f"{stage}/moved")
    left = moved.filter("NOT moved")
    if left.limit(1).count():
        left.selectExpr("name", "reason", f"{as_of_sql} AS at").write.mode("append").json(f"{store.root}/archive_failures")


def read_checkpoints(spark: SparkSession, state_root: str) -> DataFrame:
    return StateStore(spark, state_root).checkpoints().select("source", "watermark")


def run_api_job(
    spark: SparkSession,
    pages_root: str,
    state_root: str,
    *,
    source_object: str = "/students",
    as_of_sql: str = "current_timestamp()",
    correlation_id: str | None = None,
    incremental: bool = True,
) -> DataFrame:
    """Staged API pages -> claim -> audit (S6) -> envelopes (S4) -> newer than the watermark
    (S5) -> core -> merge -> progress -> watermark (K4) -> end.

    Every run is a fresh one under its own id. A page is a chunk (dedupe scope) and pages
    merge in page order; pages without a number are numbered by file name. Chain and
    envelopes are checked before anything is committed; the watermark moves only after the
    snapshot commit and never backwards. A run that fails is recorded as failed and raises.
    `incremental` leaves out records that are not newer than the stored watermark; those
    without a readable time are kept, to be quarantined.
    """
    return _api_job(
        spark, state_root, lambda stage: _page_records(spark, pages_root, stage), source_object=source_object,
        as_of_sql=as_of_sql, correlation_id=correlation_id, incremental=incremental,
    )


def ingest_records(
    spark: SparkSession, records: DataFrame, state_root: str, *, run_id: str, source_object: str = "/students", as_of_sql: str = "current_timestamp()"
) -> DataFrame:
    """`run_api_job` over records (page, item_pos, payload as JSON text) that a stream hands over.
    A `run_id` that was completed before is skipped, one that ended early is taken up again."""
    named = records.selectExpr("page AS page_no", "item_pos", "payload AS _payload")
    return _api_job(
        spark, state_root, lambda stage: _staged(named, f"{stage}/records"), source_object=source_object,
        as_of_sql=as_of_sql, correlation_id=run_id, incremental=False, version=run_id,
    )


def _api_job(spark, state_root, records, *, source_object, as_of_sql, correlation_id, incremental, version=None) -> DataFrame:
    """`records`: a function of the run's staging folder."""
    ensure_session(spark)
    store = StateStore(spark, state_root)
    run = uuid.uuid4().hex
    correlation = correlation_id or run
    stage = f"{store.root}/staging/{run}"
    wanted = spark.range(1).selectExpr(
        f"'{S.API_SOURCE_SYSTEM}' AS source", f"{sql_str(source_object)} AS source_object_id",
        f"{sql_str(version or run)} AS source_version",
    )
    claims = _claim(store, wanted, stage, as_of_sql=as_of_sql, stale_after_seconds=3600, correlation=correlation)
    if claims is None:
        return spark.createDataFrame([], SUMMARY_SCHEMA).drop("run_status", "error")
    try:
        return _api_run(spark, store, records(stage), claims, stage, source_object, as_of_sql, correlation, incremental)
    except Exception as failure:
        error = sql_str(f"{type(failure).__name__}: {failure}")
        store.append_ledger(
            _event(claims, ENDED, "'failed'", as_of_sql, correlation, error=L.fail_event_sql(error), completed_at=as_of_sql)
        )
        raise


def _page_records(spark: SparkSession, pages_root: str, stage: str) -> DataFrame:
    """page_no, item_pos and _payload of the staged pages, whose chain is checked first."""
    from ingestry.sources import pages as PG

    # The only read of the page bodies: numbers, links and records, as JSON text.
    raw = spark.read.option("wholetext", "true").text(pages_root).selectExpr("value AS body", "_metadata.file_name AS page_file")
    pages = _staged(PG.staged_pages(raw), f"{stage}/pages")
    order = _numbered(pages.select("page_file", "page"), "page_file", "nth", f"{stage}/page_order")
    pages = pages.join(order.selectExpr("page_file", "coalesce(page, nth) AS page_no"), "page_file")
    problems = _staged(
        PG.chain_violations(pages.selectExpr("0 AS run_id", "page_no AS page", "next_page", "next_url"))
        .unionByName(pages.filter("records IS NULL").selectExpr("0 AS run_id", "page_no AS page", "'no_record_list' AS problem")),
        f"{stage}/problems",
    )
    n = problems.count()
    if n:
        shown = [(r["page"], r["problem"]) for r in problems.orderBy("page", "problem").limit(SHOWN_FAILURES).collect()]
        raise UnsafePages(f"{n} problem(s) in the pages, listed in {stage}/problems: {shown}")
    return pages.selectExpr("page_no", "posexplode(records) AS (item_pos, _payload)")


def _api_run(spark, store, records, claims, stage, source_object, as_of_sql, correlation, incremental) -> DataFrame:
    recs = records.selectExpr("*", "parse_json(_payload) AS item").selectExpr(
        f"{sql_str(source_object)} AS {S.SOURCE_OBJECT}",
        f"CAST(0 AS BIGINT) AS {S.FILE_ORDINAL}",
        f"CAST(page_no AS BIGINT) AS {S.CHUNK_INDEX}",
        f"CAST(item_pos + 1 AS BIGINT) AS {S.ROW_ORDINAL}",
        f"false AS {S.IS_CSV}",
        f"CAST(NULL AS ARRAY<STRING>) AS {S.EXTRA_COLUMNS}",
        "_payload",
        *[f"try_variant_get(item, '$.{f}', 'string') AS {f}" for f in S.CANONICAL_FIELDS],
    )
    if incremental:
        since = store.checkpoints().filter(f"source = '{S.API_SOURCE_SYSTEM}'").agg(F.max("watermark")).first()[0]
        if since is not None:
            newer = F.expr(timestamp_sql("btrim(updated_at)")) > F.lit(since)
            recs = recs.filter(F.coalesce(newer, F.lit(True)))
    batch = core.Batch(
        recs, as_of=as_of_sql, source_system=S.API_SOURCE_SYSTEM, payload_sql="_payload", record_sql="_payload"
    ).staged(f"{stage}/marked")
    errors = spark.createDataFrame([], "run long, error string")
    tagged = _commit(
        store, batch, claims, errors, stage, name="source_object_id", as_of_sql=as_of_sql, correlation=correlation, n_claims=1,
        watermark_of=S.API_SOURCE_SYSTEM,
    )
    return M.run_summary(tagged)
