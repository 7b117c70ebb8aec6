"""Operator 5, sharding: permutation-filled lookup table.

Every shard walks its own permutation of a prime-sized table; the shards take turns, each
claiming the next free slot of its walk, until the table is full. Shares differ by at most
one slot, and adding or losing a shard moves few slots. A document's slot is a hash of its
key; the table (``table_size`` rows of two ints, a fixed size) is broadcast, so placement is
one hash and one lookup per row, without a shuffle.

Edge cases: a null key is placed by the text's hash, so null keys spread over all shards;
null key and null text share one slot; equal keys share a shard; an empty table gives none.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65537  # prime; 65,537 rows of two ints bound the broadcast at about 1 MB
SHARDS = 64


def preference(shard: str, size: int) -> tuple[int, int]:
    """Offset and step of the shard's walk through the table."""
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:16], "big") % (size - 1) + 1


def fill_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """slot -> index of the shard that claimed it; shards claim in turn."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shard names must be distinct, at least one, at most one per slot")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be prime")
    walks = [preference(s, size) for s in shards]
    nexts = [0] * len(shards)
    table, free = [-1] * size, size
    while free:
        for k, (offset, step) in enumerate(walks):
            slot = (offset + nexts[k] * step) % size
            while table[slot] >= 0:
                nexts[k] += 1
                slot = (offset + nexts[k] * step) % size
            table[slot] = k
            nexts[k] += 1
            free -= 1
            if not free:
                break
    return table


def place(
    docs: DataFrame,
    shards: list[str] | None = None,
    key_col: str = "doc_id",
    text_col: str = "text",
    size: int = TABLE_SIZE,
) -> DataFrame:
    """docs with ``slot`` and ``shard`` (the shard's name); the input's columns are kept
    unless they bear these two names."""
    spark: SparkSession = docs.sparkSession
    names = shards or [f"shard-{k:03d}" for k in range(SHARDS)]
    table = spark.createDataFrame(
        [(slot, names[k]) for slot, k in enumerate(fill_table(names, size))], "_slot int, _shard string"
    )
    text = F.xxhash64(F.lit("text"), F.col(text_col)) if text_col in docs.columns else F.lit(0).cast("long")
    slot = F.pmod(F.when(F.col(key_col).isNull(), text).otherwise(F.xxhash64(key_col)), F.lit(size)).cast("int")
    rows = docs.select(F.struct("*").alias("_row"), slot.alias("_slot"))
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in ("slot", "shard")]
    return rows.join(F.broadcast(table), "_slot").select(
        *kept, F.col("_slot").alias("slot"), F.col("_shard").alias("shard")
    )


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 4) -> None:
    """One folder per shard. A shard's rows go to ``files_per_shard`` tasks, so no task
    holds a whole shard."""
    salt = F.pmod(F.xxhash64(*[c for c in placed.columns if c != "shard"]), F.lit(files_per_shard))
    placed.withColumn("_salt", salt).repartition("shard", "_salt").drop("_salt").write.partitionBy("shard").parquet(path)
