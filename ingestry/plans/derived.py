"""Relations derived from the driver tables, in Spark.

`dirty_records` turns every `events` row into a landing-file record with messy
values, using only CASE arithmetic on the row's own columns, so the DuckDB oracle
reproduces the same relation and its size grows with `events`.

Layout: 500 events per landing file, 100 rows per chunk; even files form the
already-merged target, odd files the incoming run. The expressions are SQL text
(one JVM call each) rather than Column trees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.session import ensure_session

ROWS_PER_FILE = 500
CHUNK_SIZE = 100
# Fixed evaluation clock of the driver queries (the future check compares with it).
AS_OF = "2024-01-29 12:00:00"
AS_OF_SQL = f"TIMESTAMP'{AS_OF}'"


def as_of() -> Column:
    return F.expr(AS_OF_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_ISO = "yyyy-MM-dd\\'T\\'HH:mm:ss"
_HOUR = "date_trunc('hour', ts)"

DIRTY_RECORD_COLUMNS = [
    f"CAST(floor(event_id / {ROWS_PER_FILE}) AS BIGINT) AS {S.FILE_ORDINAL}",
    f"concat('landing/students-', lpad(CAST(CAST(floor(event_id / {ROWS_PER_FILE}) AS BIGINT) AS STRING), 5, '0'), '.csv') AS {S.SOURCE_OBJECT}",
    f"CAST(event_id % {ROWS_PER_FILE} + 1 AS BIGINT) AS {S.ROW_ORDINAL}",
    f"CAST(floor((event_id % {ROWS_PER_FILE}) / {CHUNK_SIZE}) + 1 AS BIGINT) AS {S.CHUNK_INDEX}",
    f"true AS {S.IS_CSV}",
    f"CASE WHEN event_id % 211 = 17 THEN array('unexpected') END AS {S.EXTRA_COLUMNS}",
    "event_type AS _feed",
    "CASE WHEN event_id % 97 = 3 THEN '  ' ELSE concat('S', CAST(user_id AS STRING)) END AS student_id",
    "CASE WHEN event_id % 53 = 7 THEN '' "
    "WHEN event_id % 11 = 0 THEN concat('  Ann', CAST(user_id % 13 AS STRING), ' ') "
    "ELSE concat('Ann', CAST(user_id % 13 AS STRING)) END AS first_name",
    "concat('Lee', CAST(user_id % 17 AS STRING)) AS last_name",
    "CASE event_id % 20 WHEN 0 THEN 'K' WHEN 1 THEN 'PK' WHEN 2 THEN 'pre-k' WHEN 3 THEN '09' "
    "WHEN 4 THEN '10.0' WHEN 5 THEN '9.5' WHEN 6 THEN '14' WHEN 7 THEN 'TK' WHEN 8 THEN '' "
    "WHEN 9 THEN CASE WHEN event_id % 40 = 9 THEN CAST(NULL AS STRING) ELSE ' 3 ' END "
    "WHEN 10 THEN '12' WHEN 11 THEN 'Kindergarten' WHEN 12 THEN '-1' WHEN 13 THEN '+5' "
    "WHEN 14 THEN '1.2e1' WHEN 15 THEN 'Grade 9' "
    "ELSE CAST(user_id % 12 + 1 AS STRING) END AS grade_level",
    "CASE WHEN event_id % 89 = 5 THEN repeat('X', 70) "
    "ELSE concat('SCH-', lpad(CAST(user_id % 7 AS STRING), 2, '0')) END AS school_id",
    "CASE event_id % 13 WHEN 0 THEN concat(' U', CAST(user_id AS STRING), '@EXAMPLE.EDU ') "
    "WHEN 1 THEN concat('u', CAST(user_id AS STRING), '(at)example.edu') "
    "WHEN 2 THEN concat('u', CAST(user_id AS STRING), '@example') "
    "WHEN 3 THEN concat('u ', CAST(user_id AS STRING), '@example.edu') "
    "ELSE concat('u', CAST(user_id AS STRING), '@example.edu') END AS email",
    "CASE event_type WHEN 'view' THEN 'active' WHEN 'click' THEN 'Enrolled' "
    "WHEN 'purchase' THEN 'Transferred Out' WHEN 'signup' THEN 'graduated' "
    "ELSE CASE event_id % 7 WHEN 0 THEN 'withdrew' WHEN 1 THEN 'on-leave' "
    "WHEN 2 THEN 'enrolled_forever' WHEN 3 THEN 'DROPPED' WHEN 4 THEN 'Grad' "
    "WHEN 5 THEN 'not enrolled' ELSE '' END END AS enrollment_status",
    f"CASE event_id % 23 "
    f"WHEN 0 THEN concat(date_format({_HOUR} + INTERVAL 2 HOURS, '{_ISO}'), '+02:00') "
    f"WHEN 1 THEN date_format({_HOUR}, 'yyyy-MM-dd') "
    f"WHEN 2 THEN '2099-01-01T00:00:00Z' "
    f"WHEN 3 THEN concat(date_format({_HOUR}, 'yyyy/MM/dd\\'T\\'HH:mm:ss'), 'Z') "
    f"WHEN 4 THEN concat(date_format({_HOUR} - INTERVAL 4 HOURS, '{_ISO}'), '-04:00') "
    f"WHEN 5 THEN date_format({_HOUR}, '{_ISO}') "
    f"WHEN 6 THEN concat(date_format({_HOUR}, 'yyyy-MM-dd\\'T\\'HH:mm'), 'Z') "
    f"WHEN 7 THEN concat(date_format({_HOUR}, '{_ISO}'), 'z') "
    f"ELSE concat(date_format({_HOUR}, '{_ISO}'), 'Z') END AS updated_at",
    "CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 31 = 0 THEN CAST(NULL AS STRING) "
    "ELSE concat('+1-206-555-', lpad(CAST(user_id % 10000 AS STRING), 4, '0')) END AS guardian_contact",
]


def dirty_records(spark: SparkSession, sf_dir: str, *, by_chunk: bool = False) -> DataFrame:
    """`by_chunk` deals the rows out by file and chunk, the scope of the dedupe windows: the
    rule cascade then runs behind that one exchange, and the windows need no other."""
    records = table(spark, sf_dir, "events").selectExpr(*DIRTY_RECORD_COLUMNS)
    return records.repartition(S.SOURCE_OBJECT, S.CHUNK_INDEX) if by_chunk else records
