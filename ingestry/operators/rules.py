"""First-failure-wins validation cascade.

The whole rule chain is ONE `coalesce(when(rule_1, reason_1), when(rule_2, ...))`
column, so every row is classified in a single projection inside whole-stage
codegen; the split into valid/rejected is two filters over the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.functions import clean as C

REASON = "reason_code"
DETAIL = "detail"
FIELD = "field"


@dataclass(frozen=True)
class Rule:
    """One rule: when `failed` is true the row is rejected with this reason."""

    reason: str
    field: str | None
    detail: str
    failed: str  # SQL predicate over the parsed columns


def cleaned_name(field: str) -> str:
    return f"_c_{field}"


def parsed_columns(df: DataFrame, fields: Sequence[str] = S.CANONICAL_FIELDS) -> DataFrame:
    """Add cleaned text and parsed values once; the cascade and projection reuse them."""
    cleaned = [
        f"{C.clean_text_sql(f'`{f}`') if f in df.columns else 'CAST(NULL AS STRING)'} "
        f"AS {cleaned_name(f)}"
        for f in fields
    ]
    c = cleaned_name
    return (
        df.selectExpr("*", *cleaned)
        .selectExpr(
            "*",
            f"{C.email_sql(c('email'))} AS _email",
            f"{C.status_sql(c('enrollment_status'))} AS _status",
            f"{C.timestamp_sql(c('updated_at'))} AS _ts",
            f"{C.grade_sql(c('grade_level'))} AS _grade",
        )
    )


def student_rules(
    as_of_sql: str,
    *,
    file_columns: Sequence[str],
    extra_col: str = S.EXTRA_COLUMNS,
    is_csv_col: str = S.IS_CSV,
    missing_sql: str | None = None,
) -> list[Rule]:
    """The rules in order (it decides the reported reason); SQL predicates."""
    any_missing = missing_sql or " OR ".join(f"`{f}` IS NULL" for f in file_columns) or "false"
    c = cleaned_name
    rules = [
        Rule(S.MALFORMED_ROW, None, S.DETAIL_MORE_VALUES, f"`{extra_col}` IS NOT NULL"),
        Rule(
            S.MALFORMED_ROW,
            None,
            S.DETAIL_FEWER_VALUES,
            f"coalesce(`{is_csv_col}`, false) AND ({any_missing})",
        ),
    ]
    for f in S.REQUIRED_FIELDS:
        rules.append(
            Rule(S.MISSING_REQUIRED_FIELD, f, S.DETAIL_MISSING.format(field=f), f"{c(f)} IS NULL")
        )
    rules += [
        Rule(S.INVALID_EMAIL, "email", S.DETAIL_EMAIL, "_email IS NULL"),
        Rule(S.UNKNOWN_ENROLLMENT_STATUS, "enrollment_status", S.DETAIL_STATUS, "_status IS NULL"),
        Rule(S.INVALID_TIMESTAMP, "updated_at", S.DETAIL_TIMESTAMP, "_ts IS NULL"),
        Rule(
            S.INVALID_TIMESTAMP,
            "updated_at",
            S.DETAIL_FUTURE,
            f"_ts > ({as_of_sql}) + {S.FUTURE_SKEW}",
        ),
        Rule(
            S.INVALID_GRADE_LEVEL,
            "grade_level",
            S.DETAIL_GRADE,
            f"{c('grade_level')} IS NOT NULL AND _grade IS NULL",
        ),
    ]
    for f, limit in S.MAX_FIELD_LENGTHS:
        rules.append(
            Rule(
                S.FIELD_TOO_LONG,
                f,
                S.DETAIL_TOO_LONG.format(field=f, limit=limit),
                f"coalesce(char_length({c(f)}) > {limit}, false)",
            )
        )
    return rules


def cascade_sql(rules: Sequence[Rule]) -> str:
    """1-based index of the first failing rule, or null (one CASE WHEN)."""
    whens = " ".join(f"WHEN {r.failed} THEN {i}" for i, r in enumerate(rules, start=1))
    return f"CASE {whens} END"


def _lookup_sql(values: Sequence[str | None], idx: str) -> str:
    items = ", ".join("CAST(NULL AS STRING)" if v is None else C.sql_str(v) for v in values)
    return f"CASE WHEN {idx} IS NOT NULL THEN element_at(array({items}), {idx}) END"


def classify(
    df: DataFrame,
    *,
    as_of: str = "current_timestamp()",
    file_columns: Sequence[str] | None = None,
    extra_col: str = S.EXTRA_COLUMNS,
    is_csv_col: str = S.IS_CSV,
    missing_sql: str | None = None,
) -> DataFrame:
    """Add parsed columns plus `reason_code`, `detail`, `field` (null on valid rows).

    `as_of` is a SQL expression for the evaluation clock (future-date rule).
    """
    if extra_col not in df.columns:
        df = df.withColumn(extra_col, F.lit(None).cast("array<string>"))
    if is_csv_col not in df.columns:
        df = df.withColumn(is_csv_col, F.lit(False))
    cols = [c for c in (file_columns or S.CANONICAL_FIELDS) if c in df.columns]
    parsed = parsed_columns(df)
    rules = student_rules(as_of, file_columns=cols, extra_col=extra_col, is_csv_col=is_csv_col, missing_sql=missing_sql)
    # `_task` (spark_partition_id, nondeterministic) is an optimizer barrier: the
    # split filters reference it, so they are not pushed through this projection
    # with the whole cascade inlined (double regex work, codegen overflow).
    return parsed.selectExpr("*", f"{cascade_sql(rules)} AS _rule").selectExpr(
        "*",
        f"{_lookup_sql([r.reason for r in rules], '_rule')} AS {REASON}",
        f"{_lookup_sql([r.detail for r in rules], '_rule')} AS {DETAIL}",
        f"{_lookup_sql([r.field for r in rules], '_rule')} AS {FIELD}",
        "spark_partition_id() AS _task",
    ).drop("_rule")


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) from one classified plan (V10). Never raises on bad data."""
    # Referencing `_task` keeps the barrier column alive (a non-null test would be
    # folded away), so the filters stay above the projection that runs the cascade.
    valid = classified.filter(f"{REASON} IS NULL AND _task >= 0")
    rejected = classified.filter(f"{REASON} IS NOT NULL AND _task >= 0")
    return valid, rejected
