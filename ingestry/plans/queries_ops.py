"""Driver queries for ledger, metrics, quarantine, audit, alerts, sources and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.functions.payload import transform_failure_sql
from ingestry.operators import alerts as A
from ingestry.operators import audit as V
from ingestry.operators import ledger as L
from ingestry.operators import metrics as M
from ingestry.operators import quarantine as Q
from ingestry.operators import reports as O
from ingestry.operators import rules as R
from ingestry.operators import upsert as U
from ingestry.plans import derived as X
from ingestry.plans.queries import _batch, _incoming, _target, ntz, query
from ingestry.sources import incremental as I
from ingestry.sources import landing as LD
from ingestry.sources import pages as PG

# Fixed per-feed watermarks of the derived checkpoint table (feeds not listed have none).
WATERMARKS = {"view": "2024-01-20 00:00:00", "click": "2024-01-10 00:00:00", "purchase": "2024-01-25 00:00:00"}


def _checkpoints(spark, sf_dir):
    """One row per feed seen in the data; CASE gives the stored watermark."""
    case = " ".join(f"WHEN '{k}' THEN TIMESTAMP'{v}'" for k, v in WATERMARKS.items())
    feeds = X.table(spark, sf_dir, "events").select(F.col("event_type").alias("source")).distinct()
    return feeds.selectExpr("source", f"CASE source {case} END AS watermark").filter("watermark IS NOT NULL")


# ---------------------------------------------------------------- S5 / A4 / K4
@query
def incremental_extract(spark, sf_dir):
    s = _batch(spark, sf_dir).students
    out = I.newer_than_watermark(s, _checkpoints(spark, sf_dir), key="_feed")
    return out.select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        "student_id",
        F.col("_feed").alias("feed"),
        ntz("updated_at").alias("updated_at"),
    )


@query
def watermark_candidate(spark, sf_dir):
    c = M.watermark_candidates(_batch(spark, sf_dir).students, key="_feed")
    return c.select("source", ntz("watermark").alias("watermark"))


@query
def watermark_advance(spark, sf_dir):
    cand = M.watermark_candidates(_batch(spark, sf_dir).students, key="_feed")
    adv = L.advance_watermarks(_checkpoints(spark, sf_dir), cand)
    return adv.select("source", ntz("old_watermark").alias("old_watermark"), ntz("watermark").alias("watermark"), "advanced")


# ---------------------------------------------------------------- J2 / J3 / J4
def _listing(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.selectExpr(
        "'csv' AS source",
        "concat('landing/order-', CAST(o_orderkey AS STRING), '.csv') AS source_object_id",
        f"{L.source_version_sql('CAST(o_custkey % 5 AS STRING)', '5000')} AS source_version",
    )


def _ledger(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.filter("o_orderkey % 4 <> 0").selectExpr(
        "o_orderkey AS run_id",
        "'csv' AS source",
        "concat('landing/order-', CAST(o_orderkey AS STRING), '.csv') AS source_object_id",
        "CASE WHEN o_orderkey % 10 = 1 THEN '9:5000' "
        f"ELSE {L.source_version_sql('CAST(o_custkey % 5 AS STRING)', '5000')} END AS source_version",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status",
        "CAST(o_orderkey % 9 AS INT) AS last_chunk",
        f"timestampadd(MINUTE, -CAST((o_orderkey % 5) * 30 AS INT), {X.AS_OF_SQL}) AS started_at",
    )


@query
def claim_new_files(spark, sf_dir):
    return L.claim_new(_listing(spark, sf_dir), _ledger(spark, sf_dir)).select("source_object_id", "source_version")


@query
def claim_decision(spark, sf_dir):
    d = L.claim_decisions(_listing(spark, sf_dir), _ledger(spark, sf_dir), as_of_sql=X.AS_OF_SQL)
    return d.selectExpr("source_object_id", "source_version", "run_id", "decision", "CAST(resume_from AS INT) AS resume_from")


@query
def resume_filter(spark, sf_dir):
    recs = X.dirty_records(spark, sf_dir)
    files = recs.groupBy(S.SOURCE_OBJECT, S.FILE_ORDINAL).agg(F.count(F.lit(1)).alias("_n"))
    listing = files.selectExpr("'csv' AS source", f"`{S.SOURCE_OBJECT}` AS source_object_id", "'v1:100' AS source_version", f"`{S.FILE_ORDINAL}` AS f")
    ledger = listing.filter("f % 3 <> 0").selectExpr(
        "source", "source_object_id", "source_version", "f AS run_id",
        "CASE WHEN f % 3 = 1 THEN 'failed' ELSE 'completed' END AS status",
        "CAST(f % 4 + 1 AS INT) AS last_chunk",
        f"{X.AS_OF_SQL} AS started_at",
    )
    claims = L.claim_decisions(listing.drop("f"), ledger, as_of_sql=X.AS_OF_SQL)
    kept = L.resume_filter(recs, claims, object_col=S.SOURCE_OBJECT)
    return kept.groupBy(
        F.col(S.SOURCE_OBJECT).alias("source_object"), F.col(S.CHUNK_INDEX).alias("chunk_index")
    ).agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- A1 / A2
def _run_tagged(spark, sf_dir):
    b = _batch(spark, sf_dir, files="incoming")
    narrow = b.students.select("student_id", "updated_at", S.SOURCE_OBJECT, S.FILE_ORDINAL, S.CHUNK_INDEX)
    actions = U.sequential_actions(_target(spark, sf_dir, payload=("student_id", "updated_at")), narrow)
    return M.tagged_from_marked(
        b.marked, actions, run=S.SOURCE_OBJECT, chunk=S.CHUNK_INDEX, tf_sql=transform_failure_sql()
    )


@query
def run_summary(spark, sf_dir):
    s = M.run_summary(_run_tagged(spark, sf_dir))
    return s.select(*[c for c in s.columns if c != "max_updated_at"], ntz("max_updated_at").alias("max_updated_at"))


@query
def job_totals(spark, sf_dir):
    return M.job_totals(M.run_summary(_run_tagged(spark, sf_dir)))


@query
def chunk_progress(spark, sf_dir):
    per = M.per_chunk_counts(_run_tagged(spark, sf_dir))
    return L.progress(per, run_col="_run", chunk_col="_chunk").withColumnRenamed("_run", "source_object")


# ---------------------------------------------------------------- U1 / A3 / V11
@query
def quarantine_union(spark, sf_dir):
    q = _batch(spark, sf_dir).quarantine
    record = [f"get_json_object(record, '$.{k}') AS r_{k}" for k in ("student_id", "email", "_extra_columns", "_source_line")]
    return q.selectExpr(
        "source_object", "chunk_index", "row_ordinal", "student_id", R.REASON, R.FIELD, R.DETAIL, *record,
        "CAST(size(json_object_keys(record)) AS BIGINT) AS n_keys",
    )


@query
def quarantine_reason_counts(spark, sf_dir):
    return Q.reason_counts(_batch(spark, sf_dir).quarantine)


@query
def constraint_audit(spark, sf_dir):
    """The table as it would be stored if nothing were rejected: typed columns, unmapped
    statuses as they came."""
    stored = R.parsed_columns(X.dirty_records(spark, sf_dir)).selectExpr(
        f"`{S.SOURCE_OBJECT}` AS source_object", f"`{S.ROW_ORDINAL}` AS row_ordinal",
        "_c_student_id AS student_id", "_c_first_name AS first_name", "_c_last_name AS last_name",
        "_c_school_id AS school_id", "_email AS email", "_ts AS updated_at",
        "coalesce(_status, lower(_c_enrollment_status)) AS enrollment_status",
        "CASE WHEN _c_grade_level RLIKE '^[+-]?[0-9]+$' THEN try_cast(_c_grade_level AS DOUBLE) END AS grade_level",
        "_c_guardian_contact AS guardian_contact",
    )
    return V.stored_violations(stored, id_cols=("source_object", "row_ordinal"))


# ---------------------------------------------------------------- M1-M4
LOG_EVENT_SQL = (
    "CASE WHEN event_type = 'error' AND value < 25 THEN 'csv.file_failed' "
    "WHEN event_type = 'error' THEN 'api.sync_failed' "
    "WHEN event_type = 'purchase' THEN 'quarantine.written' "
    "WHEN event_type = 'signup' AND value < 10 THEN 'trigger.csv_finished' "
    "WHEN event_type = 'view' AND value > 40 THEN 'trigger.api_finished' "
    "ELSE 'chunk.persisted' END"
)


def _logs(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    logs = e.selectExpr(
        "ts AS timestamp",
        "CASE WHEN event_type = 'error' AND value >= 25 THEN 'exception' ELSE 'trace' END AS item_type",
        f"concat('{{\"event\": \"', {LOG_EVENT_SQL}, '\", \"records\": ', "
        "coalesce(get_json_object(props, '$.k'), '0'), '}') AS message",
    )
    return logs.filter("item_type = 'trace'"), logs.filter("item_type = 'exception'")


@query
def alert_failures(spark, sf_dir):
    traces, exceptions = _logs(spark, sf_dir)
    return A.pipeline_failures(traces, exceptions)


@query
def alert_quarantine_spike(spark, sf_dir):
    traces, _ = _logs(spark, sf_dir)
    return A.quarantine_spike(traces, threshold=100)


@query
def alert_missed_csv_runs(spark, sf_dir):
    traces, _ = _logs(spark, sf_dir)
    return A.missed_runs(traces, event="trigger.csv_finished", window_hours=26, as_of_sql=X.AS_OF_SQL)


@query
def alert_missed_api_runs(spark, sf_dir):
    traces, _ = _logs(spark, sf_dir)
    return A.missed_runs(traces, event="trigger.api_finished", window_hours=2, as_of_sql=X.AS_OF_SQL)


# ---------------------------------------------------------------- S4 / S6 / K6
def _staged_pages(spark, sf_dir):
    """Each conversation packed as one API page; envelope shape by conv_id % 5.

    `collect_list` per conversation is bounded by one conversation's turns (a page),
    not by the table; pages are built in parallel across conversations.
    """
    c = X.table(spark, sf_dir, "conversations")
    items = c.groupBy("conv_id").agg(
        F.expr(
            "to_json(array_sort(collect_list(named_struct('conv_id', conv_id, 'turn', turn, "
            "'role', role, 'text', text)), (a, b) -> CASE WHEN a.turn < b.turn THEN -1 "
            "WHEN a.turn > b.turn THEN 1 ELSE 0 END))"
        ).alias("items")
    )
    items = items.selectExpr(
        "conv_id",
        "CASE WHEN conv_id % 3 = 0 THEN concat('[null,7,', substr(items, 2)) ELSE items END AS items",
    )
    return items.selectExpr(
        "conv_id AS page_id",
        "CASE WHEN conv_id % 5 = 4 AND conv_id % 7 = 0 THEN '{\"status\": \"no list\"}' ELSE CASE conv_id % 5 "
        "WHEN 0 THEN concat('{\"page\": ', CAST(conv_id AS STRING), ', \"data\": ', items, '}') "
        "WHEN 1 THEN concat('{\"students\": ', items, ', \"next_page\": null}') "
        "WHEN 2 THEN concat('{\"items\": ', items, '}') "
        "WHEN 3 THEN items "
        "ELSE concat('{\"data\": {\"note\": \"x\"}, \"results\": ', items, '}') END END AS body",
    )


@query
def envelope_extract(spark, sf_dir):
    recs = PG.extract_records(_staged_pages(spark, sf_dir), keep=("page_id",))
    return recs.selectExpr(
        "try_variant_get(item, '$.conv_id', 'bigint') AS conv_id",
        "try_variant_get(item, '$.turn', 'bigint') AS turn",
        "try_variant_get(item, '$.role', 'string') AS role",
        "try_variant_get(item, '$.text', 'string') AS text",
        "CASE WHEN page_error IS NOT NULL THEN page_id END AS failed_page",
    )


def _page_chain(spark, sf_dir):
    p = X.table(spark, sf_dir, "pages")
    return p.selectExpr(
        "CAST(floor(page_id / 10) AS BIGINT) AS run_id",
        "CASE WHEN page_id % 43 = 9 AND page_id % 10 > 0 THEN page_id % 10 ELSE page_id % 10 + 1 END AS page",
        "CASE WHEN page_id % 37 = 5 THEN CAST(page_id % 10 + 1 AS STRING) "
        "WHEN page_id % 41 = 7 THEN 'abc' "
        "WHEN page_id % 10 = 9 THEN CAST(NULL AS STRING) "
        "ELSE CAST(page_id % 10 + 2 AS STRING) END AS next_page",
        "CASE WHEN page_id % 7 = 3 AND page_id % 10 < 9 THEN "
        "concat(url, '?cursor=x&page=', CAST(page_id % 10 + 2 AS STRING)) END AS next_url",
    )


@query
def page_chain_audit(spark, sf_dir):
    return PG.chain_violations(_page_chain(spark, sf_dir))


# The last part of the page's address stands in each name.
SLUG_SQL = "right(regexp_extract(url, '([^/]*)/?$', 1), 40)"
FILE_NAME_SQL = (
    "CASE page_id % 10 "
    "WHEN 0 THEN concat('../bad path/students ', slug, ' final.csv') "
    "WHEN 1 THEN concat('Roster ', slug, '.XLSX') "
    "WHEN 2 THEN concat('scan-', slug, '.pdf') "
    "WHEN 3 THEN concat('photo_', slug, '.JPG') "
    "WHEN 4 THEN concat('notes ', slug, '.docx') "
    "WHEN 5 THEN concat('export_', slug, '.txt') "
    "WHEN 6 THEN concat('C:\\\\Users\\\\staff\\\\roster ', slug, '.CSV') "
    "WHEN 7 THEN if(page_id % 20 = 7, '...---', concat(slug, '...---')) "
    "WHEN 8 THEN concat('__students__', slug, '.csv.') "
    "ELSE concat('dir/sub/', 'na\\u00efve ', slug, '.csv') END"
)


@query
def file_triage(spark, sf_dir):
    p = X.table(spark, sf_dir, "pages").selectExpr("page_id", f"{SLUG_SQL} AS slug").selectExpr("page_id", f"{FILE_NAME_SQL} AS candidate")
    t = LD.upload_triage(
        p, name="candidate", now_sql=X.AS_OF_SQL, unique_id_sql="concat('p', CAST(page_id AS STRING))"
    )
    return t.selectExpr(
        "page_id", "candidate", f"{LD.is_csv_sql('candidate')} AS eligible", "accepted", "object_name", "message"
    )


# ---------------------------------------------------------------- O3
def _merged(spark, sf_dir):
    few = ("student_id", "updated_at", "school_id", "enrollment_status")
    new_target, _ = U.sequential_upsert(_target(spark, sf_dir, payload=few), _incoming(spark, sf_dir), as_of=X.as_of(), payload=few)
    return new_target


def _report_cols(df):
    return df.select("student_id", ntz("updated_at").alias("updated_at"), "school_id", "enrollment_status")


@query
def report_latest(spark, sf_dir):
    return _report_cols(O.newest(_merged(spark, sf_dir), k=20))


@query
def report_by_school(spark, sf_dir):
    return _report_cols(O.newest(_merged(spark, sf_dir), k=10, where="school_id = 'SCH-03'"))


@query
def report_by_status(spark, sf_dir):
    return _report_cols(O.newest(_merged(spark, sf_dir), k=10, where="enrollment_status = 'active'"))


@query
def report_failed_runs(spark, sf_dir):
    r = O.newest_runs(_ledger(spark, sf_dir), status="failed", k=20)
    return r.select("run_id", "source_object_id", ntz("started_at").alias("started_at"), "last_chunk")
