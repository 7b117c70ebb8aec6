"""Canonical projection (P7), raw payload (P6), transform guard (P8) and the
quarantine record object (P10), as SQL expression text over the parsed columns
of `rules.classify`."""

from __future__ import annotations

from collections.abc import Sequence

from ingestry import schema as S
from ingestry.functions.clean import sql_str

_JSON_OPTS = "map('ignoreNullFields', 'false')"


# The source columns of a file in one map, by header name: its payload, and whether the row
# had too few values.
MAP_PAYLOAD_SQL = "to_json(_src)"
MAP_MISSING_SQL = "exists(map_values(_src), v -> v IS NULL)"


def raw_payload_sql(file_columns: Sequence[str]) -> str:
    """Source record as received (source spelling and order), bookkeeping keys removed."""
    if not file_columns:
        return "'{}'"
    pairs = ", ".join(f"{sql_str(c)}, `{c.replace('`', '``')}`" for c in file_columns)
    return f"to_json(named_struct({pairs}), {_JSON_OPTS})"


def record_sql(payload: str, line: str = S.ROW_ORDINAL) -> str:
    """The quarantined record of a CSV row: the source values, the surplus values where
    there are any, and the line."""
    return (
        f"concat(left({payload}, length({payload}) - 1), CASE WHEN {payload} = '{{}}' THEN '' ELSE ',' END, "
        f"CASE WHEN `{S.EXTRA_COLUMNS}` IS NOT NULL THEN concat('\"{S.EXTRA_COLUMNS}\":', to_json(`{S.EXTRA_COLUMNS}`), ',') "
        f"ELSE '' END, '\"_source_line\":', CAST(`{line}` AS STRING), '}}')"
    )


CANONICAL_SQL = (
    "_c_student_id AS student_id",
    "_c_first_name AS first_name",
    "_c_last_name AS last_name",
    "_grade AS grade_level",
    "_c_school_id AS school_id",
    "_email AS email",
    "_status AS enrollment_status",
    "_ts AS updated_at",
    "_c_guardian_contact AS guardian_contact",
)

NON_NULL_CANONICAL = (
    ("student_id", "_c_student_id"),
    ("first_name", "_c_first_name"),
    ("last_name", "_c_last_name"),
    ("school_id", "_c_school_id"),
    ("email", "_email"),
    ("enrollment_status", "_status"),
    ("updated_at", "_ts"),
)


def transform_failure_sql() -> str:
    """A validated row whose canonical value is still unusable (never raised).

    Unreachable while the rules and the projection share parsers; kept so a drift
    is quarantined as TRANSFORM_FAILED instead of failing the job.
    """
    whens = " ".join(f"WHEN {src} IS NULL THEN '{name} is not usable'" for name, src in NON_NULL_CANONICAL)
    return f"CASE {whens} END"
