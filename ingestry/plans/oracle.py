"""DuckDB oracle SQL for the driver queries (views: the driver tables).

Written in DuckDB's dialect: alias tables, white space and time formats are written out
again here, timestamps are parsed by splitting the local part from the offset, and
survivors use ROW_NUMBER. Reason codes, texts and field lists come from the schema module,
and the derivation of `dirty_records` from `events` is shared by construction. Where an
oracle repeats a definition (losers, page chains, audits), its agreement shows an equal
translation; the plain folds in tests/ check the definitions.
"""

from __future__ import annotations

from ingestry import schema as S
from ingestry.plans.derived import AS_OF, CHUNK_SIZE, ROWS_PER_FILE

# Fixed values, written out here a second time: white space, accepted times, aliases.
_SPACES = (
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288,
)
_WS = " || ".join(f"chr({c})" for c in _SPACES)
_TIME = (
    r"\d{4}(-\d\d-\d\dT\d\d(:\d\d(:\d\d([.,]\d+)?)?)?|\d{4}T\d\d(\d\d(\d\d([.,]\d+)?)?)?)"
    r"(Z|[+-]\d\d(:?\d\d(:?\d\d(\.\d{1,6})?)?)?)"
)
_STATUSES = {
    "active": "active enrolled enrolled_active",
    "inactive": "inactive unenrolled not_enrolled on_leave",
    "graduated": "graduated grad",
    "transferred": "transferred transfer transferred_out",
    "withdrawn": "withdrawn withdrew dropped",
}
_GRADES = {-1: "pk prek pre_k", 0: "k kg kindergarten"}
_ISO = "%Y-%m-%dT%H:%M:%S"
_H = "date_trunc('hour', ts)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _clean(x: str) -> str:
    return f"NULLIF(trim(CAST({x} AS VARCHAR), {_WS}), '')"


def _key(t: str) -> str:
    return f"translate(lower({t}), '- ', '__')"


_STATUS_CASE = "CASE {k} " + " ".join(
    f"WHEN {_q(a)} THEN {_q(v)}" for v, names in _STATUSES.items() for a in names.split()
) + " END"
_GRADE_ALIAS_CASE = "CASE {k} " + " ".join(
    f"WHEN {_q(a)} THEN {v}" for v, names in _GRADES.items() for a in names.split()
) + " END"

CTES: dict[str, str] = {}

CTES["dirty_records"] = f"""
SELECT
  CAST(floor(event_id / {ROWS_PER_FILE}) AS BIGINT) AS _file_ordinal,
  'landing/students-' || lpad(CAST(CAST(floor(event_id / {ROWS_PER_FILE}) AS BIGINT) AS VARCHAR), 5, '0') || '.csv' AS _source_object,
  CAST(event_id % {ROWS_PER_FILE} + 1 AS BIGINT) AS _row_ordinal,
  CAST(floor((event_id % {ROWS_PER_FILE}) / {CHUNK_SIZE}) + 1 AS BIGINT) AS _chunk_index,
  event_id % 211 = 17 AS _has_extra,
  event_type AS _feed,
  CASE WHEN event_id % 97 = 3 THEN '  ' ELSE 'S' || CAST(user_id AS VARCHAR) END AS student_id,
  CASE WHEN event_id % 53 = 7 THEN ''
       WHEN event_id % 11 = 0 THEN '  Ann' || CAST(user_id % 13 AS VARCHAR) || ' '
       ELSE 'Ann' || CAST(user_id % 13 AS VARCHAR) END AS first_name,
  'Lee' || CAST(user_id % 17 AS VARCHAR) AS last_name,
  CASE event_id % 20 WHEN 0 THEN 'K' WHEN 1 THEN 'PK' WHEN 2 THEN 'pre-k' WHEN 3 THEN '09'
    WHEN 4 THEN '10.0' WHEN 5 THEN '9.5' WHEN 6 THEN '14' WHEN 7 THEN 'TK' WHEN 8 THEN ''
    WHEN 9 THEN CASE WHEN event_id % 40 = 9 THEN NULL ELSE ' 3 ' END
    WHEN 10 THEN '12' WHEN 11 THEN 'Kindergarten' WHEN 12 THEN '-1' WHEN 13 THEN '+5'
    WHEN 14 THEN '1.2e1' WHEN 15 THEN 'Grade 9'
    ELSE CAST(user_id % 12 + 1 AS VARCHAR) END AS grade_level,
  CASE WHEN event_id % 89 = 5 THEN repeat('X', 70)
       ELSE 'SCH-' || lpad(CAST(user_id % 7 AS VARCHAR), 2, '0') END AS school_id,
  CASE event_id % 13 WHEN 0 THEN ' U' || CAST(user_id AS VARCHAR) || '@EXAMPLE.EDU '
    WHEN 1 THEN 'u' || CAST(user_id AS VARCHAR) || '(at)example.edu'
    WHEN 2 THEN 'u' || CAST(user_id AS VARCHAR) || '@example'
    WHEN 3 THEN 'u ' || CAST(user_id AS VARCHAR) || '@example.edu'
    ELSE 'u' || CAST(user_id AS VARCHAR) || '@example.edu' END AS email,
  CASE event_type WHEN 'view' THEN 'active' WHEN 'click' THEN 'Enrolled'
    WHEN 'purchase' THEN 'Transferred Out' WHEN 'signup' THEN 'graduated'
    ELSE CASE event_id % 7 WHEN 0 THEN 'withdrew' WHEN 1 THEN 'on-leave'
      WHEN 2 THEN 'enrolled_forever' WHEN 3 THEN 'DROPPED' WHEN 4 THEN 'Grad'
      WHEN 5 THEN 'not enrolled' ELSE '' END END AS enrollment_status,
  CASE event_id % 23
    WHEN 0 THEN strftime({_H} + INTERVAL 2 HOUR, '{_ISO}') || '+02:00'
    WHEN 1 THEN strftime({_H}, '%Y-%m-%d')
    WHEN 2 THEN '2099-01-01T00:00:00Z'
    WHEN 3 THEN strftime({_H}, '%Y/%m/%dT%H:%M:%S') || 'Z'
    WHEN 4 THEN strftime({_H} - INTERVAL 4 HOUR, '{_ISO}') || '-04:00'
    WHEN 5 THEN strftime({_H}, '{_ISO}')
    WHEN 6 THEN strftime({_H}, '%Y-%m-%dT%H:%M') || 'Z'
    WHEN 7 THEN strftime({_H}, '{_ISO}') || 'z'
    ELSE strftime({_H}, '{_ISO}') || 'Z' END AS updated_at,
  CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 31 = 0 THEN NULL
       ELSE '+1-206-555-' || lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0') END AS guardian_contact
FROM events
"""

_cleaned = ",\n  ".join(f"{_clean(f)} AS c_{f}" for f in S.CANONICAL_FIELDS)
CTES["cleaned"] = f"SELECT *,\n  {_cleaned}\nFROM dirty_records"

_TS_SPLIT = r"^(.*?)(Z|[+-][0-9:.]+)$"
_LOCAL_FORMATS = (
    "['%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M', '%Y-%m-%dT%H', "
    "'%Y%m%dT%H%M%S.%f', '%Y%m%dT%H%M%S', '%Y%m%dT%H%M', '%Y%m%dT%H']"
)
CTES["parsed0"] = f"""
SELECT *,
  CASE WHEN regexp_full_match(lower(c_email), '^[^@\\s,;]+@[^@\\s,;.]+(\\.[^@\\s,;.]+)+$') THEN lower(c_email) END AS p_email,
  {_STATUS_CASE.format(k=_key('c_enrollment_status'))} AS p_status,
  CAST(coalesce({_GRADE_ALIAS_CASE.format(k=_key('c_grade_level'))},
    CASE WHEN NOT contains(c_grade_level, '.') AND regexp_full_match(c_grade_level, '[+-]?[0-9]+')
              AND TRY_CAST(c_grade_level AS DOUBLE) BETWEEN -1 AND 12 THEN TRY_CAST(c_grade_level AS DOUBLE)
         WHEN contains(c_grade_level, '.') AND regexp_full_match(c_grade_level, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
              AND TRY_CAST(c_grade_level AS DOUBLE) = floor(TRY_CAST(c_grade_level AS DOUBLE))
              AND TRY_CAST(c_grade_level AS DOUBLE) BETWEEN -1 AND 12 THEN TRY_CAST(c_grade_level AS DOUBLE) END) AS SMALLINT) AS p_grade,
  CASE WHEN regexp_full_match(c_updated_at, {_q(_TIME)}) THEN
    regexp_replace(replace(c_updated_at, ',', '.'), '(\\.[0-9]{{6}})[0-9]+', '\\1') END AS ts_norm
FROM cleaned
"""
CTES["parsed1"] = f"""
SELECT *,
  try_strptime(regexp_extract(ts_norm, '{_TS_SPLIT}', 1), {_LOCAL_FORMATS}) AS ts_local,
  replace(regexp_extract(ts_norm, '{_TS_SPLIT}', 2), ':', '') AS ts_zone
FROM parsed0
"""
CTES["parsed"] = """
SELECT *,
  CASE WHEN ts_zone = 'Z' THEN ts_local
       ELSE ts_local - (CASE WHEN substr(ts_zone, 1, 1) = '-' THEN -1 ELSE 1 END) * (
              CAST(substr(ts_zone, 2, 2) AS INTEGER) * INTERVAL 1 HOUR
            + coalesce(TRY_CAST(NULLIF(substr(ts_zone, 4, 2), '') AS INTEGER), 0) * INTERVAL 1 MINUTE
            + coalesce(TRY_CAST(NULLIF(substr(ts_zone, 6, 2), '') AS INTEGER), 0) * INTERVAL 1 SECOND)
  END AS p_ts
FROM parsed1
"""

_RULES = [
    ("_has_extra", S.MALFORMED_ROW, S.DETAIL_MORE_VALUES, None),
    (
        "(" + " OR ".join(f"{f} IS NULL" for f in S.CANONICAL_FIELDS) + ")",
        S.MALFORMED_ROW,
        S.DETAIL_FEWER_VALUES,
        None,
    ),
    *[(f"c_{f} IS NULL", S.MISSING_REQUIRED_FIELD, f"{f} is missing or blank", f) for f in S.REQUIRED_FIELDS],
    ("p_email IS NULL", S.INVALID_EMAIL, S.DETAIL_EMAIL, "email"),
    ("p_status IS NULL", S.UNKNOWN_ENROLLMENT_STATUS, S.DETAIL_STATUS, "enrollment_status"),
    ("p_ts IS NULL", S.INVALID_TIMESTAMP, S.DETAIL_TIMESTAMP, "updated_at"),
    (f"p_ts > TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY", S.INVALID_TIMESTAMP, S.DETAIL_FUTURE, "updated_at"),
    ("c_grade_level IS NOT NULL AND p_grade IS NULL", S.INVALID_GRADE_LEVEL, S.DETAIL_GRADE, "grade_level"),
    *[
        (f"length(c_{f}) > {n}", S.FIELD_TOO_LONG, f"{f} is longer than {n} characters", f)
        for f, n in S.MAX_FIELD_LENGTHS
    ],
]


def _case(i: int) -> str:
    return "CASE " + " ".join(
        f"WHEN {cond} THEN {'NULL' if r[i] is None else _q(r[i])}" for r in _RULES for cond in [r[0]]
    ) + " END"


CTES["classified"] = f"""
SELECT *,
  {_case(1)} AS reason_code,
  {_case(2)} AS detail,
  {_case(3)} AS field
FROM parsed
"""
CTES["valid"] = "SELECT * FROM classified WHERE reason_code IS NULL"
CTES["rejected"] = "SELECT * FROM classified WHERE reason_code IS NOT NULL"
CTES["marked"] = """
SELECT *,
  CASE WHEN setter THEN first(CASE WHEN setter THEN p_ts END IGNORE NULLS) OVER (
         PARTITION BY _source_object, _chunk_index, c_student_id ORDER BY _row_ordinal
         ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
       ELSE rm END AS kept_at
FROM (
  SELECT *, rm IS NULL OR p_ts >= rm AS setter
  FROM (
    SELECT *, max(p_ts) OVER (
        PARTITION BY _source_object, _chunk_index, c_student_id ORDER BY _row_ordinal
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rm
    FROM valid))
"""
CTES["survivors"] = """
SELECT * FROM (
  SELECT *, row_number() OVER (
      PARTITION BY _source_object, _chunk_index, c_student_id
      ORDER BY p_ts DESC, _row_ordinal DESC) AS rn
  FROM valid) WHERE rn = 1
"""


def _iso(x: str) -> str:
    return (
        f"strftime({x}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({x}) % 1000000 <> 0 "
        f"THEN '.' || lpad(CAST(microsecond({x}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+00:00'"
    )


CTES["losers"] = f"""
SELECT *, 'duplicate student_id in the same chunk; kept the row updated at ' || {_iso('kept_at')}
          || ' instead of ' || {_iso('p_ts')} AS dup_detail
FROM marked WHERE kept_at IS NOT NULL
"""
CTES["students"] = """
SELECT _file_ordinal, _source_object, _chunk_index, _row_ordinal, _feed,
  c_student_id AS student_id, c_first_name AS first_name, c_last_name AS last_name,
  p_grade AS grade_level, c_school_id AS school_id, p_email AS email,
  p_status AS enrollment_status, p_ts AS updated_at, c_guardian_contact AS guardian_contact,
  'csv' AS source_system,
  survivors.student_id AS r_student_id, survivors.first_name AS r_first_name,
  survivors.grade_level AS r_grade_level, survivors.email AS r_email,
  survivors.updated_at AS r_updated_at, survivors.guardian_contact AS r_guardian_contact
FROM survivors
"""
CTES["target"] = f"""
SELECT student_id, first_name, last_name, grade_level, school_id, email, enrollment_status,
  updated_at, guardian_contact, source_system,
  TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS ingested_at, TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS last_written_at
FROM (SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY updated_at DESC,
        _file_ordinal ASC, _row_ordinal ASC) AS rn
      FROM students WHERE _file_ordinal % 2 = 0) WHERE rn = 1
"""
CTES["incoming"] = "SELECT * FROM students WHERE _file_ordinal % 2 = 1"
CTES["incoming_latest"] = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY updated_at DESC,
         _file_ordinal DESC, _row_ordinal DESC) AS rn,
         count(*) OVER (PARTITION BY student_id) AS submitted
  FROM incoming) WHERE rn = 1
"""
CTES["upsert_decided"] = """
SELECT s.*, CASE WHEN t.student_id IS NULL THEN 'inserted'
                 WHEN s.updated_at > t.updated_at THEN 'updated' ELSE 'skipped' END AS action
FROM incoming_latest s LEFT JOIN target t USING (student_id)
"""
CTES["seq_actions"] = """
SELECT s.*, CASE WHEN prev IS NULL THEN 'inserted' WHEN s.updated_at > prev THEN 'updated'
                 ELSE 'skipped' END AS action
FROM (
  SELECT i.*, greatest(t.updated_at, max(i.updated_at) OVER (
      PARTITION BY i.student_id ORDER BY i._file_ordinal, i._chunk_index
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS prev
  FROM incoming i LEFT JOIN target t USING (student_id)) s
"""

_TARGET_COLS = (
    "student_id, first_name, last_name, grade_level, school_id, email, enrollment_status, "
    "updated_at, guardian_contact, source_system"
)


def _merge(target: str, winners: str) -> str:
    """Full outer join of a target and accepted winners (unique keys)."""
    pick = ", ".join(
        f"CASE WHEN w.student_id IS NOT NULL THEN w.{c} ELSE t.{c} END AS {c}"
        for c in _TARGET_COLS.split(", ")
    )
    return f"""
SELECT {pick},
  CASE WHEN t.student_id IS NULL THEN TIMESTAMP '{AS_OF}' ELSE t.ingested_at END AS ingested_at,
  CASE WHEN w.student_id IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE t.last_written_at END AS last_written_at
FROM {target} t FULL OUTER JOIN {winners} w ON t.student_id = w.student_id
"""


CTES["upsert_new_target"] = _merge(
    "target", "(SELECT * FROM upsert_decided WHERE action <> 'skipped')"
)
CTES["seq_new_target"] = _merge(
    "target",
    "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY _file_ordinal DESC, "
    "_chunk_index DESC) AS rk FROM seq_actions WHERE action <> 'skipped') WHERE rk = 1)",
)

ORACLE: dict[str, tuple[tuple[str, ...], str]] = {}


def oracle(name: str, deps: tuple[str, ...], body: str) -> None:
    ORACLE[name] = (deps, body)


_ALL = ("dirty_records", "cleaned", "parsed0", "parsed1", "parsed")
_CLS = (*_ALL, "classified")

oracle("grade_normalize", _ALL, "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, grade_level AS grade_text, p_grade AS grade_level FROM parsed")
oracle("status_normalize", _ALL, "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, enrollment_status AS status_text, p_status AS enrollment_status FROM parsed")
oracle("timestamp_normalize", _ALL, "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, updated_at AS updated_at_text, p_ts AS updated_at FROM parsed")
oracle("email_normalize", _ALL, "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, email AS email_text, p_email AS email FROM parsed")
_STU = (*_CLS, "valid", "survivors", "students")
oracle(
    "canonical_projection",
    _STU,
    "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, "
    + _TARGET_COLS
    + " FROM students",
)
oracle(
    "raw_payload_json",
    _STU,
    "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, r_student_id AS p_student_id, "
    "r_first_name AS p_first_name, "
    "r_grade_level AS p_grade_level, r_email AS p_email, r_updated_at AS p_updated_at, "
    "r_guardian_contact AS p_guardian_contact, CAST(9 AS BIGINT) AS n_keys FROM students",
)
oracle("validation_split", _CLS, "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, reason_code, field, detail, reason_code IS NULL AS is_valid FROM classified")
oracle("validation_reason_counts", (*_CLS, "rejected"), "SELECT reason_code, detail, count(*) AS n FROM rejected GROUP BY reason_code, detail")
oracle("valid_records", (*_CLS, "valid"), "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, c_student_id AS student_id, p_ts AS updated_at FROM valid")
oracle("dedupe_survivors", (*_CLS, "valid", "survivors"), "SELECT _source_object AS source_object, _chunk_index AS chunk_index, c_student_id AS student_id, _row_ordinal AS row_ordinal, p_ts AS updated_at FROM survivors")
oracle("dedupe_losers", (*_CLS, "valid", "marked", "losers"), "SELECT _source_object AS source_object, _chunk_index AS chunk_index, _row_ordinal AS row_ordinal, c_student_id AS student_id, dup_detail AS detail FROM losers")
oracle(
    "distinct_on_latest",
    (*_CLS, "valid"),
    "SELECT DISTINCT ON (c_student_id) c_student_id AS student_id, p_ts AS updated_at, "
    "_source_object AS source_object, _row_ordinal AS row_ordinal FROM valid "
    "ORDER BY c_student_id, p_ts DESC, _file_ordinal DESC, _row_ordinal DESC",
)
oracle(
    "latest_order_per_customer",
    (),
    "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus "
    "FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC",
)
oracle(
    "chunk_assignment",
    ("dirty_records",),
    f"SELECT _source_object AS source_object, CAST((_row_ordinal - 1) // {CHUNK_SIZE // 2} + 1 AS BIGINT) AS chunk_index, "
    "count(*) AS rows, min(_row_ordinal) AS first_row, max(_row_ordinal) AS last_row "
    "FROM dirty_records GROUP BY 1, 2",
)
_UPS = (*_STU, "target", "incoming", "incoming_latest", "upsert_decided")
_TGT_OUT = _TARGET_COLS + ", ingested_at, last_written_at"
oracle("conditional_upsert", (*_UPS, "upsert_new_target"), f"SELECT {_TGT_OUT} FROM upsert_new_target")
oracle("upsert_actions", _UPS, "SELECT student_id, updated_at, action, submitted FROM upsert_decided")
oracle(
    "upsert_counts",
    _UPS,
    "SELECT CAST(coalesce(sum(submitted), 0) AS BIGINT) AS submitted, count(*) FILTER (WHERE action = 'inserted') AS inserted, "
    "count(*) FILTER (WHERE action = 'updated') AS updated, "
    "CAST(coalesce(sum(submitted), 0) - count(*) FILTER (WHERE action IN ('inserted', 'updated')) AS BIGINT) AS skipped "
    "FROM upsert_decided",
)
_SEQ = (*_STU, "target", "incoming", "seq_actions")
oracle("sequential_upsert_counts", _SEQ, "SELECT action, count(*) AS n FROM seq_actions GROUP BY action")
oracle("sequential_upsert_target", (*_SEQ, "seq_new_target"), f"SELECT {_TGT_OUT} FROM seq_new_target")
CTES["csv_half"] = "SELECT * FROM students WHERE _row_ordinal % 2 = 1"
CTES["api_half"] = "SELECT * FROM students WHERE _row_ordinal % 2 = 0"
CTES["after_csv"] = """
SELECT student_id, updated_at, 'csv' AS source_system, email FROM (
  SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY updated_at DESC,
      _file_ordinal DESC, _row_ordinal DESC) AS rn FROM csv_half) WHERE rn = 1
"""
CTES["api_latest"] = """
SELECT student_id, updated_at, 'api' AS source_system, email FROM (
  SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY updated_at DESC,
      _file_ordinal DESC, _row_ordinal DESC) AS rn FROM api_half) WHERE rn = 1
"""
oracle(
    "cross_source_latest",
    (*_STU, "csv_half", "api_half", "after_csv", "api_latest"),
    "SELECT coalesce(a.student_id, c.student_id) AS student_id, "
    "CASE WHEN a.updated_at > c.updated_at OR c.student_id IS NULL THEN a.updated_at ELSE c.updated_at END AS updated_at, "
    "CASE WHEN a.updated_at > c.updated_at OR c.student_id IS NULL THEN a.source_system ELSE c.source_system END AS source_system, "
    "CASE WHEN a.updated_at > c.updated_at OR c.student_id IS NULL THEN a.email ELSE c.email END AS email "
    "FROM after_csv c FULL OUTER JOIN api_latest a ON a.student_id = c.student_id",
)



# ---------------------------------------------------------------- S5 / A4 / K4
CTES["checkpoints"] = """
SELECT source, watermark FROM (
  SELECT DISTINCT event_type AS source,
    CASE event_type WHEN 'view' THEN TIMESTAMP '2024-01-20 00:00:00'
      WHEN 'click' THEN TIMESTAMP '2024-01-10 00:00:00'
      WHEN 'purchase' THEN TIMESTAMP '2024-01-25 00:00:00' END AS watermark
  FROM events) WHERE watermark IS NOT NULL
"""
CTES["candidates"] = "SELECT _feed AS source, max(updated_at) AS watermark FROM students GROUP BY _feed"
oracle(
    "incremental_extract",
    (*_STU, "checkpoints"),
    "SELECT s._source_object AS source_object, s._row_ordinal AS row_ordinal, s.student_id, s._feed AS feed, "
    "s.updated_at FROM students s LEFT JOIN checkpoints c ON c.source = s._feed "
    "WHERE c.watermark IS NULL OR s.updated_at > c.watermark",
)
oracle("watermark_candidate", (*_STU, "candidates"), "SELECT source, watermark FROM candidates")
oracle(
    "watermark_advance",
    (*_STU, "checkpoints", "candidates"),
    "SELECT coalesce(o.source, n.source) AS source, o.watermark AS old_watermark, "
    "greatest(o.watermark, n.watermark) AS watermark, "
    "coalesce(n.watermark > o.watermark OR (o.watermark IS NULL AND n.watermark IS NOT NULL), false) AS advanced "
    "FROM checkpoints o FULL OUTER JOIN candidates n ON o.source = n.source",
)

# ---------------------------------------------------------------- J2 / J3 / J4
CTES["listing"] = """
SELECT 'csv' AS source, 'landing/order-' || CAST(o_orderkey AS VARCHAR) || '.csv' AS source_object_id,
  CAST(o_custkey % 5 AS VARCHAR) || ':5000' AS source_version
FROM orders
"""
CTES["ledger"] = f"""
SELECT o_orderkey AS run_id, 'csv' AS source,
  'landing/order-' || CAST(o_orderkey AS VARCHAR) || '.csv' AS source_object_id,
  CASE WHEN o_orderkey % 10 = 1 THEN '9:5000' ELSE CAST(o_custkey % 5 AS VARCHAR) || ':5000' END AS source_version,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
  CAST(o_orderkey % 9 AS INTEGER) AS last_chunk,
  TIMESTAMP '{AS_OF}' - (o_orderkey % 5) * 30 * INTERVAL 1 MINUTE AS started_at
FROM orders WHERE o_orderkey % 4 <> 0
"""


def _decide(listing: str, ledger: str) -> str:
    return f"""
SELECT l.*, g.run_id, g.last_chunk,
  CASE WHEN g.run_id IS NULL THEN 'new' WHEN g.status = 'failed' THEN 'resumed'
       WHEN g.status = 'running' AND g.started_at <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR THEN 'stale_reclaimed'
       ELSE 'skipped' END AS decision
FROM {listing} l LEFT JOIN {ledger} g
  ON l.source = g.source AND l.source_object_id = g.source_object_id AND l.source_version = g.source_version
"""


CTES["decisions"] = _decide("listing", "ledger")
oracle(
    "claim_new_files",
    ("listing", "ledger"),
    "SELECT l.source_object_id, l.source_version FROM listing l WHERE NOT EXISTS (SELECT 1 FROM ledger g "
    "WHERE g.source = l.source AND g.source_object_id = l.source_object_id AND g.source_version = l.source_version)",
)
oracle(
    "claim_decision",
    ("listing", "ledger", "decisions"),
    "SELECT source_object_id, source_version, run_id, decision, "
    "CAST(CASE WHEN decision IN ('resumed', 'stale_reclaimed') THEN last_chunk ELSE 0 END AS INTEGER) AS resume_from "
    "FROM decisions",
)
CTES["file_listing"] = """
SELECT 'csv' AS source, _source_object AS source_object_id, 'v1:100' AS source_version, _file_ordinal AS f
FROM dirty_records GROUP BY _source_object, _file_ordinal
"""
CTES["file_ledger"] = f"""
SELECT source, source_object_id, source_version, f AS run_id,
  CASE WHEN f % 3 = 1 THEN 'failed' ELSE 'completed' END AS status,
  CAST(f % 4 + 1 AS INTEGER) AS last_chunk, TIMESTAMP '{AS_OF}' AS started_at
FROM file_listing WHERE f % 3 <> 0
"""
CTES["file_decisions"] = _decide("file_listing", "file_ledger")
oracle(
    "resume_filter",
    ("dirty_records", "file_listing", "file_ledger", "file_decisions"),
    "SELECT r._source_object AS source_object, r._chunk_index AS chunk_index, count(*) AS rows "
    "FROM dirty_records r JOIN file_decisions d ON d.source_object_id = r._source_object "
    "WHERE d.decision <> 'skipped' AND r._chunk_index > "
    "CASE WHEN d.decision IN ('resumed', 'stale_reclaimed') THEN d.last_chunk ELSE 0 END GROUP BY 1, 2",
)

# ---------------------------------------------------------------- A1 / A2
CTES["quarantine_all"] = """
SELECT _file_ordinal, _source_object AS source_object, _chunk_index AS chunk_index, _row_ordinal AS row_ordinal,
  student_id, reason_code, field, detail, student_id AS r_student_id, email AS r_email,
  CASE WHEN _has_extra THEN '["unexpected"]' END AS r__extra_columns, CAST(_row_ordinal AS VARCHAR) AS r__source_line,
  CAST(CASE WHEN _has_extra THEN 11 ELSE 10 END AS BIGINT) AS n_keys FROM rejected
UNION ALL
SELECT _file_ordinal, _source_object, _chunk_index, _row_ordinal, student_id,
  'DUPLICATE_STUDENT_ID', 'student_id', dup_detail, student_id, email, NULL, CAST(_row_ordinal AS VARCHAR), 10 FROM losers
"""
CTES["run_tagged"] = """
SELECT _source_object AS run, _chunk_index AS chunk, 1 AS rd, 0 AS q, 0 AS v, NULL AS action, NULL::TIMESTAMP AS ts
FROM dirty_records WHERE _file_ordinal % 2 = 1
UNION ALL
SELECT source_object, chunk_index, 0, 1, 0, NULL, NULL FROM quarantine_all WHERE _file_ordinal % 2 = 1
UNION ALL
SELECT _source_object, _chunk_index, 0, 0, 1, action, updated_at FROM seq_actions
"""
_Q = (*_CLS, "valid", "rejected", "marked", "losers", "survivors", "students", "target", "incoming", "seq_actions", "quarantine_all", "run_tagged")
oracle(
    "run_summary",
    _Q,
    "SELECT run AS source_object, max(chunk) AS chunks, CAST(sum(rd) AS BIGINT) AS read, CAST(sum(v) AS BIGINT) AS valid, "
    "CAST(sum(q) AS BIGINT) AS quarantined, count(*) FILTER (WHERE action = 'inserted') AS inserted, "
    "count(*) FILTER (WHERE action = 'updated') AS updated, count(*) FILTER (WHERE action = 'skipped') AS skipped, "
    "max(ts) AS max_updated_at FROM run_tagged GROUP BY run",
)
oracle(
    "job_totals",
    _Q,
    "SELECT count(*) AS files, CAST(coalesce(sum(i + u), 0) AS BIGINT) AS rows_written FROM ("
    "SELECT run, count(*) FILTER (WHERE action = 'inserted') AS i, count(*) FILTER (WHERE action = 'updated') AS u "
    "FROM run_tagged GROUP BY run)",
)
oracle(
    "chunk_progress",
    _Q,
    "SELECT run AS source_object, chunk AS last_chunk, "
    "CAST(sum(rd) OVER w AS BIGINT) AS rows_read, CAST(sum(v) OVER w AS BIGINT) AS rows_valid, "
    "CAST(sum(q) OVER w AS BIGINT) AS rows_quarantined, CAST(sum(wr) OVER w AS BIGINT) AS rows_written "
    "FROM (SELECT run, chunk, sum(rd) AS rd, sum(v) AS v, sum(q) AS q, "
    "count(*) FILTER (WHERE action IN ('inserted', 'updated')) AS wr FROM run_tagged GROUP BY run, chunk) "
    "WINDOW w AS (PARTITION BY run ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
)

# ---------------------------------------------------------------- S3
oracle(
    "csv_parse",
    (),
    f"""SELECT 'file-' || CAST(event_id // {ROWS_PER_FILE} AS VARCHAR) AS source_object,
  row_number() OVER (PARTITION BY event_id // {ROWS_PER_FILE} ORDER BY event_id) AS row_ordinal, CAST(event_id AS VARCHAR) AS event_id,
  CASE event_id % 7 WHEN 1 THEN event_type || ', "' || CAST(user_id AS VARCHAR) || '"'
    WHEN 2 THEN event_type || chr(10) || CAST(user_id AS VARCHAR) ELSE event_type END AS kind,
  CASE WHEN event_id % 11 <> 3 THEN CAST(user_id AS VARCHAR) WHEN event_id % 13 = 5 THEN 'surplus' END AS "user",
  CASE WHEN event_id % 13 = 5 THEN CASE WHEN event_id % 11 = 3 THEN ' one' ELSE 'surplus| one' END END AS surplus,
  3 AS n_names
FROM events""",
)

# ---------------------------------------------------------------- whole jobs and streams
oracle(
    "csv_job_target",
    _STU,
    f"SELECT {_TARGET_COLS}, TIMESTAMP '{AS_OF}' AS ingested_at, TIMESTAMP '{AS_OF}' AS last_written_at FROM ("
    "SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY updated_at DESC, _file_ordinal, _chunk_index) AS rn "
    "FROM students) WHERE rn = 1",
)
oracle(
    "stream_landing_target",
    _STU,
    "SELECT student_id, first_name, email, updated_at FROM ("
    "SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY updated_at DESC, _file_ordinal, _chunk_index) AS rn "
    "FROM students) WHERE rn = 1",
)
CTES["job_actions"] = """
SELECT *, prev IS NULL OR updated_at > prev AS written FROM (
  SELECT *, max(updated_at) OVER (PARTITION BY student_id ORDER BY _file_ordinal, _chunk_index
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM students)
"""
oracle(
    "csv_job_report",
    (*_CLS, "valid", "rejected", "marked", "losers", "quarantine_all", "survivors", "students", "job_actions"),
    "SELECT 'reject' AS kind, reason_code AS name, field, count(*) AS n FROM quarantine_all GROUP BY ALL UNION ALL "
    "SELECT 'completed', 'rows_read', NULL, count(*) FROM dirty_records UNION ALL "
    "SELECT 'completed', 'rows_valid', NULL, count(*) FROM students UNION ALL "
    "SELECT 'completed', 'rows_quarantined', NULL, count(*) FROM quarantine_all UNION ALL "
    "SELECT 'completed', 'rows_written', NULL, count(*) FILTER (written) FROM job_actions UNION ALL "
    "SELECT 'archived', 'whole', NULL, 0",
)
oracle(
    "csv_ranges",
    ("dirty_records",),
    "SELECT student_id, CASE WHEN grade_level IS NOT NULL THEN updated_at END AS updated_at, "
    "CASE WHEN grade_level IS NOT NULL THEN guardian_contact END AS guardian_contact, "
    "CASE WHEN _has_extra AND grade_level IS NOT NULL AND guardian_contact IS NOT NULL THEN 'unexpected' END AS surplus, "
    "CAST(1 AS BIGINT) AS lines_above FROM dirty_records",
)
oracle(
    "survivors_in_order",
    (*_CLS, "valid", "survivors"),
    "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, c_student_id AS student_id, "
    "row_number() OVER (ORDER BY _file_ordinal, _row_ordinal) AS place FROM survivors",
)
CTES["stream_chunks"] = """
SELECT *, count(*) OVER (PARTITION BY student_id, g) AS submitted,
  row_number() OVER (PARTITION BY student_id, g ORDER BY updated_at DESC, o DESC) AS rn
FROM (SELECT *, _file_ordinal % 3 AS g, _file_ordinal * 1000 + _row_ordinal AS o FROM students)
"""
oracle(
    "stream_merge_actions",
    (*_STU, "stream_chunks"),
    "SELECT student_id, updated_at, o AS place, CASE WHEN prev IS NULL THEN 'inserted' WHEN updated_at > prev THEN 'updated' "
    "ELSE 'skipped' END AS action, submitted FROM (SELECT *, max(updated_at) OVER (PARTITION BY student_id ORDER BY g "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM stream_chunks WHERE rn = 1)",
)

# ---------------------------------------------------------------- U1 / A3 / V11
_QU = (*_CLS, "valid", "rejected", "marked", "losers", "quarantine_all")
oracle("quarantine_union", _QU, "SELECT source_object, chunk_index, row_ordinal, student_id, reason_code, field, detail, r_student_id, r_email, r__extra_columns, r__source_line, n_keys FROM quarantine_all")
oracle("quarantine_reason_counts", _QU, "SELECT reason_code, count(*) AS n FROM quarantine_all GROUP BY reason_code")
_VIOL = [
    *[f"SELECT _source_object, _row_ordinal, '{n}_not_null' AS violation FROM parsed WHERE {src} IS NULL"
      for n, src in (("student_id", "c_student_id"), ("first_name", "c_first_name"), ("last_name", "c_last_name"),
                     ("school_id", "c_school_id"), ("email", "p_email"), ("enrollment_status", "c_enrollment_status"),
                     ("updated_at", "p_ts"))],
    "SELECT _source_object, _row_ordinal, 'grade_level_range' FROM parsed WHERE regexp_full_match(c_grade_level, '[+-]?[0-9]+') "
    "AND TRY_CAST(c_grade_level AS DOUBLE) NOT BETWEEN -1 AND 12",
    "SELECT _source_object, _row_ordinal, 'enrollment_status_enum' FROM parsed WHERE c_enrollment_status IS NOT NULL AND p_status IS NULL",
    *[f"SELECT _source_object, _row_ordinal, '{f}_length' FROM parsed WHERE length({'p_email' if f == 'email' else 'c_' + f}) > {n}"
      for f, n in S.MAX_FIELD_LENGTHS if f != "enrollment_status"],
    "SELECT _source_object, _row_ordinal, 'student_id_unique' FROM parsed WHERE c_student_id IN "
    "(SELECT c_student_id FROM parsed WHERE c_student_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
]
oracle(
    "constraint_audit",
    _ALL,
    "SELECT _source_object AS source_object, _row_ordinal AS row_ordinal, violation FROM ("
    + " UNION ALL ".join(_VIOL) + ")",
)

# ---------------------------------------------------------------- M1-M4
CTES["logs"] = """
SELECT ts AS timestamp,
  CASE WHEN event_type = 'error' AND value >= 25 THEN 'exception' ELSE 'trace' END AS item_type,
  CASE WHEN event_type = 'error' AND value < 25 THEN 'csv.file_failed'
       WHEN event_type = 'error' THEN 'api.sync_failed'
       WHEN event_type = 'purchase' THEN 'quarantine.written'
       WHEN event_type = 'signup' AND value < 10 THEN 'trigger.csv_finished'
       WHEN event_type = 'view' AND value > 40 THEN 'trigger.api_finished'
       ELSE 'chunk.persisted' END AS event,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS records
FROM events
"""
oracle(
    "alert_failures",
    ("logs",),
    "SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) AS window_start, "
    "time_bucket(INTERVAL 5 MINUTE, timestamp) + INTERVAL 5 MINUTE AS window_end, count(*) AS failures "
    "FROM logs WHERE item_type = 'exception' OR regexp_matches(event, '(?i)(^|[^A-Za-z0-9])(job_failed|sync_failed|file_failed)($|[^A-Za-z0-9])') "
    "GROUP BY 1, 2",
)
oracle(
    "alert_quarantine_spike",
    ("logs",),
    "SELECT window_start, window_end, total FROM (SELECT time_bucket(INTERVAL 1 HOUR, timestamp) AS window_start, "
    "time_bucket(INTERVAL 1 HOUR, timestamp) + INTERVAL 1 HOUR AS window_end, CAST(sum(records) AS BIGINT) AS total "
    "FROM logs WHERE item_type = 'trace' AND event = 'quarantine.written' GROUP BY 1, 2) WHERE total > 100",
)


def _missed(event: str, hours: int) -> str:
    return f"""
SELECT t - INTERVAL {hours} HOUR AS window_start, t AS window_end
FROM (SELECT unnest(generate_series(date_trunc('hour', TIMESTAMP '{AS_OF}') - INTERVAL 719 HOUR,
                                    date_trunc('hour', TIMESTAMP '{AS_OF}'), INTERVAL 1 HOUR)) AS t)
WHERE NOT EXISTS (SELECT 1 FROM logs l WHERE l.item_type = 'trace' AND l.event = '{event}'
                  AND l.timestamp >= t - INTERVAL {hours} HOUR AND l.timestamp < t)
"""


oracle("alert_missed_csv_runs", ("logs",), _missed("trigger.csv_finished", 26))
oracle("alert_missed_api_runs", ("logs",), _missed("trigger.api_finished", 2))

# ---------------------------------------------------------------- S4 / S6 / K6
oracle(
    "envelope_extract",
    (),
    "SELECT conv_id, turn, role, text, NULL AS failed_page FROM conversations WHERE NOT (conv_id % 5 = 4 AND conv_id % 7 = 0) "
    "UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, conv_id FROM conversations WHERE conv_id % 5 = 4 AND conv_id % 7 = 0",
)
CTES["page_chain"] = """
SELECT CAST(floor(page_id / 10) AS BIGINT) AS run_id,
  CASE WHEN page_id % 43 = 9 AND page_id % 10 > 0 THEN page_id % 10 ELSE page_id % 10 + 1 END AS page,
  CASE WHEN page_id % 37 = 5 THEN CAST(page_id % 10 + 1 AS VARCHAR) WHEN page_id % 41 = 7 THEN 'abc'
       WHEN page_id % 10 = 9 THEN NULL ELSE CAST(page_id % 10 + 2 AS VARCHAR) END AS next_page,
  CASE WHEN page_id % 7 = 3 AND page_id % 10 < 9 THEN url || '?cursor=x&page=' || CAST(page_id % 10 + 2 AS VARCHAR) END AS next_url
FROM pages
"""
CTES["page_links"] = """
SELECT run_id, page, next_page, next_url,
  coalesce(TRY_CAST(NULLIF(regexp_extract(next_url, '[?&]page=([0-9]+)', 1), '') AS BIGINT), TRY_CAST(next_page AS BIGINT)) AS nt,
  next_url IS NULL AND next_page IS NOT NULL AND NOT regexp_full_match(next_page, '[0-9]+') AS bad
FROM page_chain
"""
oracle(
    "page_chain_audit",
    ("page_chain", "page_links"),
    "SELECT run_id, page, 'non_numeric_next' AS problem FROM page_links WHERE bad "
    "UNION ALL SELECT run_id, page, 'non_advancing_next' FROM page_links WHERE NOT bad AND nt <= page "
    "UNION ALL SELECT run_id, page, 'repeated_page' FROM page_links GROUP BY run_id, page HAVING count(*) > 1 "
    "UNION ALL SELECT a.run_id, a.page, 'missing_page' FROM page_links a WHERE a.nt IS NOT NULL AND a.nt > a.page "
    "AND NOT EXISTS (SELECT 1 FROM page_links b WHERE b.run_id = a.run_id AND b.page = a.nt)",
)
CTES["candidates_files"] = """
SELECT page_id, CASE page_id % 10
  WHEN 0 THEN '../bad path/students ' || slug || ' final.csv'
  WHEN 1 THEN 'Roster ' || slug || '.XLSX'
  WHEN 2 THEN 'scan-' || slug || '.pdf'
  WHEN 3 THEN 'photo_' || slug || '.JPG'
  WHEN 4 THEN 'notes ' || slug || '.docx'
  WHEN 5 THEN 'export_' || slug || '.txt'
  WHEN 6 THEN 'C:\\Users\\staff\\roster ' || slug || '.CSV'
  WHEN 7 THEN CASE WHEN page_id % 20 = 7 THEN '...---' ELSE slug || '...---' END
  WHEN 8 THEN '__students__' || slug || '.csv.'
  ELSE 'dir/sub/' || 'na' || chr(239) || 've ' || slug || '.csv' END AS candidate
FROM (SELECT page_id, right(regexp_extract(url, '([^/]*)/?$', 1), 40) AS slug FROM pages)
"""
CTES["triaged"] = """
SELECT *, lower(regexp_extract(safe_name, '^.+(\\.[^.]*)$', 1)) AS ext FROM (
  SELECT *, trim(regexp_replace(regexp_extract(regexp_replace(replace(candidate, '\\', '/'), '/+$', ''), '([^/]*)$', 1),
                 '[^A-Za-z0-9._-]+', '-', 'g'), '.-_') AS safe_name
  FROM candidates_files)
"""
oracle(
    "file_triage",
    ("candidates_files", "triaged"),
    f"""SELECT page_id, candidate, lower(candidate) LIKE '%.csv' AS eligible,
  ext = '.csv' AND safe_name <> '' AS accepted,
  CASE WHEN ext = '.csv' AND safe_name <> '' THEN 'uploads/' || strftime(TIMESTAMP '{AS_OF}', '%Y%m%dT%H%M%SZ')
       || '-p' || CAST(page_id AS VARCHAR) || '-' || safe_name END AS object_name,
  CASE WHEN safe_name = '' THEN 'filename is empty' WHEN ext = '.csv' THEN NULL
       WHEN ext IN ('.xls', '.xlsx', '.xlsm', '.xlsb') THEN 'Excel files are not supported yet. Export as CSV.'
       WHEN ext = '.pdf' THEN 'PDF files are not supported yet. Export as CSV.'
       WHEN ext IN ('.bmp', '.gif', '.jpeg', '.jpg', '.png', '.tif', '.tiff', '.webp') THEN 'Image files are not supported yet. Export as CSV.'
       WHEN ext IN ('.doc', '.docx') THEN 'Word documents are not supported yet. Export as CSV.'
       ELSE 'uploaded file type is not supported yet. Export as CSV.' END AS message
FROM triaged""",
)

# ---------------------------------------------------------------- O3
_REP = (*_SEQ, "seq_new_target")
oracle("report_latest", _REP, "SELECT student_id, updated_at, school_id, enrollment_status FROM seq_new_target ORDER BY updated_at DESC, student_id LIMIT 20")
oracle("report_by_school", _REP, "SELECT student_id, updated_at, school_id, enrollment_status FROM seq_new_target WHERE school_id = 'SCH-03' ORDER BY updated_at DESC, student_id LIMIT 10")
oracle("report_by_status", _REP, "SELECT student_id, updated_at, school_id, enrollment_status FROM seq_new_target WHERE enrollment_status = 'active' ORDER BY updated_at DESC, student_id LIMIT 10")
oracle("report_failed_runs", ("ledger",), "SELECT run_id, source_object_id, started_at, last_chunk FROM ledger WHERE status = 'failed' ORDER BY started_at DESC, run_id LIMIT 20")


def render(name: str) -> str:
    deps, body = ORACLE[name]
    if not deps:
        return body.strip()
    ctes = ",\n".join(f"{d} AS (\n{CTES[d].strip()}\n)" for d in deps)
    return f"WITH {ctes}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: render(name) for name in ORACLE}
