"""Reporting reads (O3): newest-first top-k reads.

`orderBy(...).limit(k)` plans as TakeOrderedAndProject: each task keeps its own
top k, so only k rows per task reach the final merge. Sort keys end in a unique
column so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def newest(students: DataFrame, *, k: int, where: str | None = None) -> DataFrame:
    df = students.filter(where) if where else students
    return df.orderBy(df.updated_at.desc(), df.student_id.asc()).limit(k)


def newest_runs(ledger: DataFrame, *, status: str, k: int) -> DataFrame:
    df = ledger.filter(f"status = '{status}'")
    return df.orderBy(df.started_at.desc(), df.run_id.asc()).limit(k)
