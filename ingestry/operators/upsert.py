"""Conditional upsert ("strictly newer wins") and its sequential-fold classification.

J1  one batch against the stored table: full outer join on the key, both sides
    unique per key (incoming reduced by W3 first), so the join is skew-free.
W4  a whole run at once with the counts a chunk-by-chunk merge would give. The
    running max per key over earlier chunks is computed in three levels: inside
    blocks of BLOCK_CHUNKS chunks of a file, across the blocks of BLOCK_FILES
    files, and across those groups of files. So a hot key is spread over (key,
    block) and (key, group) partitions, and a window by key alone sees one row
    per group of files.
A5  outcome counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.operators.dedupe import latest_per_key

INSERTED = "inserted"
UPDATED = "updated"
SKIPPED = "skipped"

BLOCK_CHUNKS = 64
BLOCK_FILES = 256
WRITTEN = ("ingested_at", "last_written_at")
PAYLOAD = tuple(c for c in S.TARGET_COLUMNS if c not in WRITTEN)


def _merge_rows(target: DataFrame, winners: DataFrame, as_of: Column, key: str, payload: Sequence[str]) -> DataFrame:
    """Full outer join of unique-key sides; a winner is taken if it is strictly newer."""
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in (*payload, *WRITTEN)])
    w = winners.select(*[F.col(c).alias(f"s_{c}") for c in payload])
    joined = t.join(w, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer").withColumn("_as_of", as_of)
    take = f"coalesce(t_{key} IS NULL OR s_updated_at > t_updated_at, false)"
    return joined.selectExpr(
        *[f"CASE WHEN {take} THEN s_{c} ELSE t_{c} END AS {c}" for c in payload],
        f"CASE WHEN t_{key} IS NULL THEN _as_of ELSE t_ingested_at END AS ingested_at",
        f"CASE WHEN {take} THEN _as_of ELSE t_last_written_at END AS last_written_at",
    )


def conditional_upsert(
    target: DataFrame,
    incoming: DataFrame,
    *,
    as_of: Column,
    key: str = "student_id",
    order: str = S.ROW_ORDINAL,
    payload: Sequence[str] = PAYLOAD,
) -> tuple[DataFrame, DataFrame]:
    """Returns (new_target, actions[key, updated_at, action, submitted]).

    `payload` names the columns carried through the merge; a reader of few columns pays
    for those only.

    `DISTINCT ON (key) ORDER BY updated_at DESC` first (tie -> larger `order`),
    then ONE full outer join with the stored table: an update only when the
    incoming `updated_at` is strictly greater. Both outputs come from that join.
    """
    cols = [*payload, order]
    latest = latest_per_key(
        incoming.select(*cols), key=key, ts="updated_at", tiebreak=order, count_as="_n"
    )
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in (*payload, *WRITTEN)])
    w = latest.select(*[F.col(c).alias(f"s_{c}") for c in (*payload, "_n")])
    joined = t.join(w, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer").selectExpr(
        "*",
        f"CASE WHEN s_{key} IS NULL THEN NULL WHEN t_{key} IS NULL THEN '{INSERTED}' "
        f"WHEN s_updated_at > t_updated_at THEN '{UPDATED}' ELSE '{SKIPPED}' END AS action",
    ).withColumn("_as_of", as_of)
    take = f"coalesce(action IN ('{INSERTED}', '{UPDATED}'), false)"
    new_target = joined.selectExpr(
        *[f"CASE WHEN {take} THEN s_{c} ELSE t_{c} END AS {c}" for c in payload],
        f"CASE WHEN t_{key} IS NULL THEN _as_of ELSE t_ingested_at END AS ingested_at",
        f"CASE WHEN {take} THEN _as_of ELSE t_last_written_at END AS last_written_at",
    )
    actions = joined.filter(f"s_{key} IS NOT NULL").selectExpr(
        f"s_{key} AS {key}", "s_updated_at AS updated_at", "action", "s__n AS submitted"
    )
    return new_target, actions


def upsert_counts(actions: DataFrame) -> DataFrame:
    """A5: submitted / inserted / updated / skipped (skipped by subtraction).

    `actions` carry `submitted` = incoming rows folded into each key by W3.
    """
    acts = actions.agg(
        F.coalesce(F.sum("submitted"), F.lit(0)).cast("bigint").alias("submitted"),
        F.count_if(F.col("action") == INSERTED).alias("inserted"),
        F.count_if(F.col("action") == UPDATED).alias("updated"),
    )
    return acts.select(
        "submitted",
        "inserted",
        "updated",
        (F.col("submitted") - F.col("inserted") - F.col("updated")).alias("skipped"),
    )


def sequential_actions(
    target: DataFrame,
    survivors: DataFrame,
    *,
    key: str = "student_id",
    seq: Sequence[str] = (S.FILE_ORDINAL, S.CHUNK_INDEX),
    block_chunks: int = BLOCK_CHUNKS,
    block_files: int = BLOCK_FILES,
) -> DataFrame:
    """Classify each chunk survivor as if chunks were merged one by one.

    prev = greatest(stored updated_at, max updated_at of the key in earlier chunks)
    inserted if prev is null, updated if updated_at > prev, else skipped.
    `survivors` hold at most one row per (key, seq) (after W1); `seq` names the ordinals of
    file and chunk.
    """
    major, minor = seq
    blk = F.floor(F.col(minor) / block_chunks).cast("bigint")
    part = [key, major, "_blk"]
    # One exchange that all branches below read: filters which the optimizer infers for some of
    # them stop above the partition id, and would else set the branches' inputs apart.
    dealt = survivors.withColumn("_blk", blk).repartition(*part).withColumn("_dealt", F.spark_partition_id())
    s = dealt.filter("_dealt >= 0").drop("_dealt")
    in_block = Window.partitionBy(*part).orderBy(minor).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_prev_in_block", F.max("updated_at").over(in_block))

    group = F.expr(f"`{major}` div {block_files}").alias("_group")
    per_block = s.groupBy(*part, group).agg(F.max(F.greatest("updated_at", "_prev_in_block")).alias("_bmax"))
    in_group = Window.partitionBy(key, "_group").orderBy(major, "_blk").rowsBetween(Window.unboundedPreceding, -1)
    per_group = per_block.groupBy(key, "_group").agg(F.max("_bmax").alias("_gmax"))
    across = Window.partitionBy(key).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    stored = target.select(key, F.col("updated_at").alias("_stored"))
    per_group = (
        per_group.withColumn("_earlier", F.max("_gmax").over(across))
        .join(stored, key, "left")
        .select(key, "_group", F.greatest("_stored", "_earlier").alias("_ground"))
    )
    per_block = (
        per_block.withColumn("_before", F.max("_bmax").over(in_group))
        .join(per_group, [key, "_group"])
        .select(*part, F.greatest("_ground", "_before").alias("_base"))
    )
    prev = F.greatest(F.col("_base"), F.col("_prev_in_block"))
    return (
        s.join(per_block, part, "inner")
        .withColumn("_prev", prev)
        .withColumn(
            "action",
            F.when(F.col("_prev").isNull(), F.lit(INSERTED))
            .when(F.col("updated_at") > F.col("_prev"), F.lit(UPDATED))
            .otherwise(F.lit(SKIPPED)),
        )
        .drop("_blk", "_prev_in_block", "_base", "_prev")
    )


def sequential_upsert(
    target: DataFrame,
    survivors: DataFrame,
    *,
    as_of: Column,
    key: str = "student_id",
    seq: Sequence[str] = (S.FILE_ORDINAL, S.CHUNK_INDEX),
    payload: Sequence[str] = PAYLOAD,
) -> tuple[DataFrame, DataFrame]:
    """W4 + J1 for a whole run: (new_target, per-survivor actions).

    A key's row after the fold is the one of its newest time, of equal ones the first in chunk
    order, if it is newer than the stored one: later ones aren't strictly newer, earlier ones
    were replaced. So the new table needs no actions, only that aggregate (map-side partial)
    and one unique-key outer join.
    """
    rest = [c for c in payload if c not in (key, "updated_at")]
    backwards = ", ".join(f"-`{c}`" for c in seq)
    last = survivors.groupBy(key).agg(
        F.expr(f"max(struct(updated_at, struct({backwards}) AS _at, {', '.join(rest)}))").alias("_w")
    )
    winners = last.selectExpr(key, "_w.updated_at", *[f"_w.{c} AS {c}" for c in rest])
    return _merge_rows(target, winners, as_of, key, payload), sequential_actions(target, survivors, key=key, seq=seq)


def initial_target(
    students: DataFrame, *, written_at: Column, key: str = "student_id", payload: Sequence[str] = PAYLOAD
) -> DataFrame:
    """A stored table from canonical rows (latest per key; earliest row wins ties)."""
    ranked = students.selectExpr("*", f"struct(-`{S.FILE_ORDINAL}` AS f, -`{S.ROW_ORDINAL}` AS r) AS _rank")
    latest = latest_per_key(ranked.select(*payload, "_rank"), key=key, ts="updated_at", tiebreak="_rank")
    return latest.select(
        *payload, written_at.alias("ingested_at"), written_at.alias("last_written_at")
    )
