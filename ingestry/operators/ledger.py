"""Run ledger, resume points and per-source high-watermarks.

The ledger is a small keyed table (one row per file version and chunk size). All
operators are joins/aggregates on it; none collects it. Joins against the ledger
are left to AQE, which broadcasts it only when its measured size is below
`spark.sql.autoBroadcastJoinThreshold` and keeps a sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.functions.clean import sql_str

IDENTITY = ("source", "source_object_id", "source_version")
NEW, RESUMED, STALE, SKIP = "new", "resumed", "stale_reclaimed", "skipped"


def source_version_sql(version: str, chunk_size: str) -> str:
    """A file is identified by (name, version, chunk size)."""
    return f"concat_ws(':', {version}, CAST({chunk_size} AS STRING))"


def claim_new(listing: DataFrame, ledger: DataFrame, keys: Sequence[str] = IDENTITY) -> DataFrame:
    """Listed file versions with no ledger row yet (left anti join)."""
    return listing.join(ledger.select(*keys), list(keys), "left_anti")


def claim_decisions(
    listing: DataFrame,
    ledger: DataFrame,
    *,
    as_of_sql: str,
    stale_after_seconds: int = 3600,
    keys: Sequence[str] = IDENTITY,
    owner: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """New / resumed (failed) / stale_reclaimed (running too long) / skipped.

    A run that is still `running` under the caller's own correlation id (`owner`) is the
    caller's, left by an attempt that ended early, and is resumed. `carry` names further
    ledger columns to bring along.

    `resume_from` is the last committed chunk for reclaimed runs, else 0.
    """
    if stale_after_seconds < 1:
        raise ValueError("stale_after_seconds must be at least 1")
    g = ledger.select(*keys, "run_id", "status", "last_chunk", "started_at", *carry)
    mine = f" OR (status = 'running' AND correlation_id = {sql_str(owner)})" if owner else ""
    stale = (
        f"status = 'running' AND started_at <= ({as_of_sql}) - "
        f"make_dt_interval(0, 0, 0, {stale_after_seconds})"
    )
    decision = (
        f"CASE WHEN run_id IS NULL THEN '{NEW}' WHEN status = 'failed'{mine} THEN '{RESUMED}' "
        f"WHEN {stale} THEN '{STALE}' ELSE '{SKIP}' END"
    )
    return (
        listing.join(g, list(keys), "left")
        .selectExpr("*", f"{decision} AS decision")
        .selectExpr(
            "*",
            f"CASE WHEN decision IN ('{RESUMED}', '{STALE}') THEN last_chunk ELSE 0 END AS resume_from",
        )
    )


def resume_filter(
    chunks: DataFrame, claims: DataFrame, *, object_col: str, chunk_col: str = S.CHUNK_INDEX
) -> DataFrame:
    """Rows of claimed files whose chunk was not committed yet."""
    c = claims.filter(f"decision <> '{SKIP}'").select(
        F.col("source_object_id").alias(object_col), "resume_from"
    )
    return chunks.join(c, object_col, "inner").filter(f"`{chunk_col}` > resume_from")


def progress(per_chunk: DataFrame, *, run_col: str, chunk_col: str) -> DataFrame:
    """A2: ledger progression after each chunk: last_chunk and four running counters.

    `per_chunk` has one row per (run, chunk) with read/valid/quarantined/written,
    so the window holds one small row per chunk of a run.
    """
    w = f"PARTITION BY `{run_col}` ORDER BY `{chunk_col}` ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return per_chunk.selectExpr(
        f"`{run_col}`",
        f"`{chunk_col}` AS last_chunk",
        f"sum(read) OVER ({w}) AS rows_read",
        f"sum(valid) OVER ({w}) AS rows_valid",
        f"sum(quarantined) OVER ({w}) AS rows_quarantined",
        f"sum(written) OVER ({w}) AS rows_written",
    )


def fail_event_sql(error: str) -> str:
    """K3: the stored error text is cut to a fixed limit."""
    return f"substring({error}, 1, {S.ERROR_TEXT_LIMIT})"


def latest_state(events: DataFrame) -> DataFrame:
    """Latest ledger row per run from append-only ledger events: the last attempt's last
    phase (claimed, in progress, ended), within it the last chunk."""
    cols = [c for c in events.columns if c not in ("run_id", "phase")]
    return events.groupBy("run_id").agg(
        F.max_by(F.struct(*cols), F.struct("attempt", "phase", "last_chunk")).alias("_s")
    ).select("run_id", *[F.col(f"_s.{c}").alias(c) for c in cols])


def advance_watermarks(checkpoints: DataFrame, candidates: DataFrame, *, key: str = "source") -> DataFrame:
    """K4: GREATEST(old, new) per source; a late run never moves it back."""
    return (
        checkpoints.select(key, F.col("watermark").alias("old_watermark"))
        .join(candidates.select(key, F.col("watermark").alias("candidate")), key, "full_outer")
        .selectExpr(
            key,
            "old_watermark",
            "greatest(old_watermark, candidate) AS watermark",
            "coalesce(candidate > old_watermark OR (old_watermark IS NULL AND candidate IS NOT NULL), false) AS advanced",
        )
    )
