"""Shared folder, staging and input helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes 09-0D and 20 separate words; everything else is part of one. Listed singly:
# Java's regular expressions test a list by one lookup, ranges by a chain of calls.
WORD_BREAKS = r"[\x20\x09\x0A\x0B\x0C\x0D]+"
SIEVE_WORDS = 1 << 20
HAS_WORD = r"[^\x20\x09\x0A\x0B\x0C\x0D]"


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, WORD_BREAKS, -1), ""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a folder of our own only on a local
    master that names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_dir(spark.sparkContext.applicationId)


@lru_cache
def _own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="ingestry-shared-")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage is cut, and
    later passes survive lost executors without repeating the work."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, as generated columns: the optimizer doesn't push filters on them into
    the expressions below, which it would copy once per reference."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def chosen(rows: DataFrame, total: int, wanted: int, *cols: str | Column) -> DataFrame:
    """About ``wanted`` of ``total`` rows (all, if there are no more), the same ones every
    time: those whose hash is small. Each task decides alone, so nothing is ranked or sent
    anywhere to be cut."""
    if total <= wanted:
        return rows
    span = 1 << 40
    return rows.filter(F.pmod(F.xxhash64(F.lit(wanted), *cols), F.lit(span)) < int(span * wanted / total))


def _sieve_bits(cols: tuple[str, ...]) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit(7), *cols)
    one = F.lit(1).cast("long")
    bit = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, k).bitwiseAND(F.lit(63)).cast("int")) for k in (40, 50)]
    return h.bitwiseAND(F.lit(SIEVE_WORDS - 1)), bit[0].bitwiseOR(bit[1])


def sieve(keys: DataFrame, *cols: str) -> DataFrame:
    """A Bloom filter over the keys as rows (_slot, _bits): at most SIEVE_WORDS of them however
    many keys there are, so it can always be broadcast. The more keys, the more it lets pass."""
    slot, bits = _sieve_bits(cols)
    return keys.select(slot.alias("_slot"), bits.alias("_bits")).groupBy("_slot").agg(F.bit_or("_bits").alias("_bits"))


def sifted(rows: DataFrame, words: DataFrame, *cols: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the sieve, rows whose key is not); nothing is shuffled."""
    slot, bits = _sieve_bits(cols)
    tried = rows.withColumns({"_want": bits, "_at": slot}).join(F.broadcast(words), F.col("_at") == F.col("_slot"), "left")
    passes = F.coalesce(F.col("_bits").bitwiseAND(F.col("_want")) == F.col("_want"), F.lit(False))
    own = rows.columns
    return tried.filter(passes).select(*own), tried.filter(~passes).select(*own)
