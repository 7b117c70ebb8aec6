"""Driver queries: one per inventory operator, each (spark, sf_dir) -> DataFrame.

Every query reads the given tables (through `derived`) so its work grows with
them. Timestamps leave as TIMESTAMP_NTZ in UTC so results do not depend on the
reader's time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.operators import core
from ingestry.operators import dedupe as D
from ingestry.operators import rules as R
from ingestry.operators import upsert as U
from ingestry.plans import derived as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def ntz(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz")


def _batch(spark: SparkSession, sf_dir: str, *, files: str = "all") -> core.Batch:
    """Even files = already merged target, odd files = the incoming run. The dedupe scope
    is per file, so each half is filtered before its windows and cascade."""
    recs = X.dirty_records(spark, sf_dir, by_chunk=True)
    if files != "all":
        recs = recs.filter(F.col(S.FILE_ORDINAL) % 2 == (0 if files == "target" else 1))
    return core.process(recs, as_of=X.AS_OF_SQL)


# The merge queries return no raw payload, so none is built or carried.
COLUMNS = tuple(c for c in U.PAYLOAD if c != "raw_payload")


def _target(spark: SparkSession, sf_dir: str, payload=COLUMNS) -> DataFrame:
    students = _batch(spark, sf_dir, files="target").students
    return U.initial_target(students, written_at=X.as_of() - F.expr("INTERVAL 1 DAY"), payload=payload)


# ---------------------------------------------------------------- P1-P5 scalars
def _parsed(spark, sf_dir):
    return R.parsed_columns(X.dirty_records(spark, sf_dir))


@query
def grade_normalize(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.col("grade_level").alias("grade_text"),
        F.col("_grade").alias("grade_level"),
    )


@query
def status_normalize(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.col("enrollment_status").alias("status_text"),
        F.col("_status").alias("enrollment_status"),
    )


@query
def timestamp_normalize(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.col("updated_at").alias("updated_at_text"),
        ntz("_ts").alias("updated_at"),
    )


@query
def email_normalize(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.col("email").alias("email_text"),
        F.col("_email").alias("email"),
    )


# ---------------------------------------------------------------- P6/P7 projection
@query
def canonical_projection(spark, sf_dir):
    s = _batch(spark, sf_dir).students
    return s.select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        "student_id",
        "first_name",
        "last_name",
        "grade_level",
        "school_id",
        "email",
        "enrollment_status",
        ntz("updated_at").alias("updated_at"),
        "guardian_contact",
        "source_system",
    )


@query
def raw_payload_json(spark, sf_dir):
    s = _batch(spark, sf_dir).students
    j = F.col("raw_payload")
    return s.select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.get_json_object(j, "$.student_id").alias("p_student_id"),
        F.get_json_object(j, "$.first_name").alias("p_first_name"),
        F.get_json_object(j, "$.grade_level").alias("p_grade_level"),
        F.get_json_object(j, "$.email").alias("p_email"),
        F.get_json_object(j, "$.updated_at").alias("p_updated_at"),
        F.get_json_object(j, "$.guardian_contact").alias("p_guardian_contact"),
        F.size(F.json_object_keys(j)).cast("bigint").alias("n_keys"),
    )


# ---------------------------------------------------------------- V1-V10 cascade
@query
def validation_split(spark, sf_dir):
    c = _batch(spark, sf_dir).classified
    return c.select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.col(R.REASON),
        F.col(R.FIELD),
        F.col(R.DETAIL),
        F.col(R.REASON).isNull().alias("is_valid"),
    )


@query
def validation_reason_counts(spark, sf_dir):
    _, rejected = R.split(_batch(spark, sf_dir).classified)
    return rejected.groupBy(R.REASON, R.DETAIL).agg(F.count(F.lit(1)).alias("n"))


@query
def valid_records(spark, sf_dir):
    valid, _ = R.split(_batch(spark, sf_dir).classified)
    return valid.select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.col("_c_student_id").alias("student_id"),
        ntz("_ts").alias("updated_at"),
    )


# ---------------------------------------------------------------- W1-W3 dedupe
@query
def dedupe_survivors(spark, sf_dir):
    s = _batch(spark, sf_dir).survivors
    return s.select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.CHUNK_INDEX).alias("chunk_index"),
        F.col("_c_student_id").alias("student_id"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        ntz("_ts").alias("updated_at"),
    )


@query
def dedupe_losers(spark, sf_dir):
    lo = _batch(spark, sf_dir).losers
    return lo.select(
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.CHUNK_INDEX).alias("chunk_index"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
        F.col("_c_student_id").alias("student_id"),
        F.col(R.DETAIL),
    )


@query
def distinct_on_latest(spark, sf_dir):
    valid, _ = R.split(_batch(spark, sf_dir).classified)
    ranked = valid.select(
        F.col("_c_student_id").alias("student_id"),
        F.col("_ts").alias("updated_at"),
        F.struct(S.FILE_ORDINAL, S.ROW_ORDINAL).alias("_rank"),
        F.col(S.SOURCE_OBJECT).alias("source_object"),
        F.col(S.ROW_ORDINAL).alias("row_ordinal"),
    )
    latest = D.latest_per_key(ranked, key="student_id", ts="updated_at", tiebreak="_rank")
    return latest.select(
        "student_id", ntz("updated_at").alias("updated_at"), "source_object", "row_ordinal"
    )


@query
def latest_order_per_customer(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"
    )
    latest = D.latest_per_key(o, key="o_custkey", ts="o_orderdate", tiebreak="o_orderkey")
    return latest.select("o_custkey", "o_orderkey", ntz("o_orderdate").alias("o_orderdate"), "o_totalprice", "o_orderstatus")


# ---------------------------------------------------------------- S3g chunks
@query
def chunk_assignment(spark, sf_dir):
    from ingestry.sources.csv import assign_chunks

    recs = X.dirty_records(spark, sf_dir).select(S.SOURCE_OBJECT, S.ROW_ORDINAL)
    chunked = assign_chunks(recs, chunk_size=X.CHUNK_SIZE // 2)
    return chunked.groupBy(
        F.col(S.SOURCE_OBJECT).alias("source_object"), F.col(S.CHUNK_INDEX).alias("chunk_index")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(S.ROW_ORDINAL).alias("first_row"),
        F.max(S.ROW_ORDINAL).alias("last_row"),
    )


# ---------------------------------------------------------------- S3 CSV text
# Events as CSV files of 500 rows with every line ending, quoted commas and newlines, blank
# lines, doubled quotes, and rows with a value too many or too few.
_ENDING = "CASE f % 3 WHEN 0 THEN '\\n' WHEN 1 THEN '\\r\\n' ELSE '\\r' END"
_CSV_LINE = (
    "concat(CAST(event_id AS STRING), ',', "
    "CASE event_id % 7 WHEN 1 THEN concat('\"', event_type, ', \"\"', CAST(user_id AS STRING), '\"\"\"') "
    "WHEN 2 THEN concat('\"', event_type, '\\n', CAST(user_id AS STRING), '\"') ELSE event_type END, "
    "CASE WHEN event_id % 11 = 3 THEN '' ELSE concat(',', CAST(user_id AS STRING)) END, "
    "CASE WHEN event_id % 13 = 5 THEN ',surplus, one' ELSE '' END, "
    "CASE WHEN event_id % 17 = 4 THEN '\\n' WHEN event_id % 5 = 1 THEN '\\r' ELSE '' END)"
)


def csv_files(spark, sf_dir) -> DataFrame:
    """(name, body): the rendered files; a file's rows, at most 500, are gathered."""
    e = X.table(spark, sf_dir, "events").selectExpr(
        "event_id", f"CAST(floor(event_id / {X.ROWS_PER_FILE}) AS BIGINT) AS f", f"{_CSV_LINE} AS line"
    )
    files = e.groupBy("f").agg(F.sort_array(F.collect_list(F.struct("event_id", "line"))).alias("rows"))
    return files.selectExpr(
        "concat('file-', CAST(f AS STRING)) AS name",
        f"CAST(concat(' Event_ID ,KIND,user', {_ENDING}, array_join(transform(rows, r -> r.line), {_ENDING})) AS BINARY) AS body",
    )


@query
def csv_parse(spark, sf_dir):
    from ingestry.sources import csv as CSV

    rows = csv_files(spark, sf_dir).mapInArrow(CSV.parse_bodies, CSV.BODY_SCHEMA)
    return rows.selectExpr(
        "source_object", "row_ordinal", "src['event_id'] AS event_id", "src['kind'] AS kind", "src['user'] AS user",
        "array_join(extra, '|') AS surplus", "size(src) AS n_names",
    )


# ---------------------------------------------------------------- J1 / W4 / A5
def _target_out(df: DataFrame) -> DataFrame:
    return df.select(
        "student_id",
        "first_name",
        "last_name",
        "grade_level",
        "school_id",
        "email",
        "enrollment_status",
        ntz("updated_at").alias("updated_at"),
        "guardian_contact",
        "source_system",
        ntz("ingested_at").alias("ingested_at"),
        ntz("last_written_at").alias("last_written_at"),
    )


RANK_SQL = f"struct(`{S.FILE_ORDINAL}`, `{S.ROW_ORDINAL}`) AS _rank"


def _incoming(spark, sf_dir):
    """Incoming canonical rows with a unique source-order tiebreak `_rank`."""
    return _batch(spark, sf_dir, files="incoming").students.selectExpr("*", RANK_SQL)


@query
def conditional_upsert(spark, sf_dir):
    new_target, _ = U.conditional_upsert(_target(spark, sf_dir), _incoming(spark, sf_dir), as_of=X.as_of(), order="_rank", payload=COLUMNS)
    return _target_out(new_target)


@query
def upsert_actions(spark, sf_dir):
    _, actions = U.conditional_upsert(_target(spark, sf_dir), _incoming(spark, sf_dir), as_of=X.as_of(), order="_rank", payload=COLUMNS)
    return actions.select("student_id", ntz("updated_at").alias("updated_at"), "action", "submitted")


@query
def upsert_counts(spark, sf_dir):
    _, actions = U.conditional_upsert(_target(spark, sf_dir), _incoming(spark, sf_dir), as_of=X.as_of(), order="_rank", payload=COLUMNS)
    return U.upsert_counts(actions)


@query
def sequential_upsert_counts(spark, sf_dir):
    narrow = _incoming(spark, sf_dir).select("student_id", "updated_at", S.FILE_ORDINAL, S.CHUNK_INDEX)
    acts = U.sequential_actions(_target(spark, sf_dir, payload=("student_id", "updated_at")), narrow)
    return acts.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query
def sequential_upsert_target(spark, sf_dir):
    new_target, _ = U.sequential_upsert(_target(spark, sf_dir), _incoming(spark, sf_dir), as_of=X.as_of(), payload=COLUMNS)
    return _target_out(new_target)


@query
def cross_source_latest(spark, sf_dir):
    """The CSV half is merged first, then the API half; strictly newer wins."""
    s = _batch(spark, sf_dir).students
    csv = s.filter(F.col(S.ROW_ORDINAL) % 2 == 1).withColumn("source_system", F.lit("csv"))
    api = s.filter(F.col(S.ROW_ORDINAL) % 2 == 0).withColumn("source_system", F.lit("api"))
    rank = F.struct(S.FILE_ORDINAL, S.ROW_ORDINAL)
    csv = csv.withColumn("_rank", rank)
    api = api.withColumn("_rank", rank)
    empty = spark.createDataFrame([], S.STUDENT_SCHEMA)
    few = ("student_id", "updated_at", "source_system", "email")
    after_csv, _ = U.conditional_upsert(empty, csv, as_of=X.as_of(), order="_rank", payload=few)
    after_api, _ = U.conditional_upsert(after_csv, api, as_of=X.as_of(), order="_rank", payload=few)
    return after_api.select("student_id", ntz("updated_at").alias("updated_at"), "source_system", "email")

from ingestry.plans import queries_ops as _ops  # noqa: E402,F401  (registers the rest)
from ingestry.plans import queries_jobs as _jobs  # noqa: E402,F401
