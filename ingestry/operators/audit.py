"""Constraint audits (V11): the rules of the stored table and of the run ledger as queries
that return what violates them; an empty result means that they hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry import schema as S


def stored_checks() -> list[str]:
    """SQL: the name of each violated row rule of the stored table, else null."""
    checks = [f"CASE WHEN {c} IS NULL THEN '{c}_not_null' END" for c in S.REQUIRED_FIELDS]
    checks.append(
        f"CASE WHEN grade_level NOT BETWEEN {S.MIN_GRADE_LEVEL} AND {S.MAX_GRADE_LEVEL} THEN 'grade_level_range' END"
    )
    statuses = ", ".join(f"'{s}'" for s in S.ENROLLMENT_STATUSES)
    checks.append(f"CASE WHEN enrollment_status NOT IN ({statuses}) THEN 'enrollment_status_enum' END")
    for f, n in S.MAX_FIELD_LENGTHS:
        if f != "enrollment_status":
            checks.append(f"CASE WHEN char_length({f}) > {n} THEN '{f}_length' END")
    return checks


def ledger_checks() -> list[str]:
    counters = ("last_chunk", "rows_read", "rows_valid", "rows_quarantined", "rows_written")
    statuses = ", ".join(f"'{s}'" for s in S.RUN_STATUSES)
    return [
        f"CASE WHEN status IS NULL OR status NOT IN ({statuses}) THEN 'status_enum' END",
        *[f"CASE WHEN {c} IS NULL THEN '{c}_not_null' END" for c in ("source", "source_object_id", "source_version")],
        *[f"CASE WHEN {c} < 0 THEN '{c}_negative' END" for c in counters],
    ]


def _violations(rows: DataFrame, checks: Sequence[str], ids: Sequence[str], key: Sequence[str], name: str) -> DataFrame:
    """Rule by rule and row by row, then repeated keys: counted first (map-side), so a hot
    key is one row before the join back, which AQE splits where it is skewed."""
    quoted = [f"`{c}`" for c in ids]
    # every check as a row, the passed ones filtered out: all of it in generated code
    single = rows.selectExpr(*quoted, f"explode(array({', '.join(checks)})) AS violation").filter("violation IS NOT NULL")
    keyed = rows.dropna(subset=list(key))
    repeated = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*key)
    twice = keyed.join(repeated, list(key), "left_semi").selectExpr(*quoted, f"'{name}' AS violation")
    return single.unionByName(twice)


def stored_violations(students: DataFrame, *, id_cols: Sequence[str] = ("student_id",)) -> DataFrame:
    """Violations of the typed stored table: NOT NULL, ranges, lengths, statuses, unique key."""
    return _violations(students, stored_checks(), id_cols, ("student_id",), "student_id_unique")


def ledger_violations(runs: DataFrame) -> DataFrame:
    """Violations of the ledger (one row per run): statuses, counters, unique identity."""
    return _violations(
        runs, ledger_checks(), ("run_id",), ("source", "source_object_id", "source_version"), "identity_unique"
    )
