"""Deterministic duplicate handling.

Within a chunk the freshest `updated_at` wins and a tie goes to the LATER row.
Folding rows one by one gives the same outcome; here it is computed with two
window passes over `(source_object, chunk, key)` partitions, which are bounded by
the chunk size, so a hot key is spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.functions.clean import iso_utc_sql
from ingestry.operators import rules as R

KEPT_AT = "_kept_at"


def mark_chunk_duplicates(
    valid: DataFrame,
    *,
    key: str = "_c_student_id",
    ts: str = "_ts",
    order: str = S.ROW_ORDINAL,
    scope: Sequence[str] = (S.SOURCE_OBJECT, S.CHUNK_INDEX),
) -> DataFrame:
    """Add `_kept_at`: null for the survivor, else the winner's time when this row lost.

    rm      = max(ts) over earlier rows of the group
    setter  = rm is null or ts >= rm            (row took the lead when it arrived)
    kept_at = setter ? ts of the next setter     (the row that displaced it)
                     : rm                        (lost on arrival to the running best)
    Both windows share one partitioning and ordering: one exchange, one sort.
    """
    part = ", ".join(f"`{c}`" for c in (*scope, key))
    spec = f"PARTITION BY {part} ORDER BY `{order}`"
    return (
        valid.selectExpr("*", f"max(`{ts}`) OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _rm")
        .selectExpr("*", f"_rm IS NULL OR `{ts}` >= _rm AS _setter")
        .selectExpr(
            "*",
            f"CASE WHEN _setter THEN first(CASE WHEN _setter THEN `{ts}` END, true) "
            f"OVER ({spec} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) "
            f"ELSE _rm END AS {KEPT_AT}",
        )
        .drop("_rm", "_setter")
    )


def survivors(marked: DataFrame) -> DataFrame:
    """One row per (scope, key)."""
    return marked.filter(f"{KEPT_AT} IS NULL")


def in_source_order(rows: DataFrame) -> DataFrame:
    """O2: rows in the order of their files, chunks and lines: dealt out by ranges of that order
    and sorted in each, so the parts of a write, read by name, give the source's order and no
    task holds them all."""
    order = [S.FILE_ORDINAL, S.CHUNK_INDEX, S.ROW_ORDINAL]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def loser_detail_sql(ts: str = "_ts") -> str:
    """The duplicate explanation: winner's time at that moment vs the loser's."""
    return (
        "concat('duplicate student_id in the same chunk; kept the row updated at ', "
        f"{iso_utc_sql(KEPT_AT)}, ' instead of ', {iso_utc_sql(ts)})"
    )


def losers(marked: DataFrame, *, ts: str = "_ts") -> DataFrame:
    """Displaced rows with the explanation text."""
    detail = loser_detail_sql(ts)
    cols = [f"`{c}`" for c in marked.columns if c not in (R.REASON, R.DETAIL, R.FIELD)]
    return marked.filter(f"{KEPT_AT} IS NOT NULL").selectExpr(
        *cols,
        f"'{S.DUPLICATE_STUDENT_ID}' AS {R.REASON}",
        f"{detail} AS {R.DETAIL}",
        f"'student_id' AS {R.FIELD}",
    )


def latest_per_key(
    df: DataFrame,
    *,
    key: str,
    ts: str,
    tiebreak: str,
    columns: Sequence[str] | None = None,
    count_as: str | None = None,
) -> DataFrame:
    """W3 `DISTINCT ON (key) ORDER BY key, ts DESC` with a deterministic tiebreak.

    Implemented as an aggregate (`max` of a struct) rather than a window: the
    partial aggregate runs map-side, so a key holding a third of all rows is
    reduced before the shuffle instead of landing whole in one task.
    """
    cols = list(columns or [c for c in df.columns if c != key])
    payload = [c for c in cols if c not in (ts, tiebreak)]
    fields = ", ".join([f"`{ts}` AS _o1", f"`{tiebreak}` AS _o2", *[f"`{c}`" for c in payload]])
    aggs = [f"max(struct({fields})) AS _best"]
    if count_as:
        aggs.append(f"count(1) AS `{count_as}`")
    agg = df.groupBy(key).agg(*[F.expr(a) for a in aggs])
    picked = {ts: "_best._o1", tiebreak: "_best._o2", **{c: f"_best.`{c}`" for c in payload}}
    return agg.selectExpr(
        f"`{key}`", *[f"{picked[c]} AS `{c}`" for c in cols], *([f"`{count_as}`"] if count_as else [])
    )
