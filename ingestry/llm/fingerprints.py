"""Operator 13, document fingerprints (native): weighted SimHash and permuted block tables.

A document's terms are its pairs of adjacent words (a single word stands alone), lower case;
each occurrence votes with its length in characters, up to ``MAX_WEIGHT``, so that pairs of
stop words say little. Bit b of the fingerprint is set where the term hashes with bit b set
outweigh the others, of 128 bits. The votes travel in 64 sums, two bits to a long: the sums of
a text's terms are one hash aggregation in the task that holds the text.

``near`` finds all fingerprints within a Hamming radius: the bits are cut into ``blocks``
blocks, and of two fingerprints at most ``radius`` bits apart at least blocks - radius blocks
agree. So there is one table for every choice of that many blocks, keyed by them, and a join
on the key meets every close pair in some table. It counts in the first such table only. A key
with more than ``BUCKET`` fingerprints is split: one side is dealt over so many parts, the
other goes to each of them.

``edited`` gives every document the beginning of the next one in place of its end. The order
is found on narrow rows (sorted by ranges, numbered by the sizes of the ranges before); of the
texts, only the beginnings that are asked for move a second time.

Edge cases: a null text counts as empty; a text without words has fingerprint zero. Rows that
repeat id and text are one document, and come back as often as they came. Ties in the order
(equal ids, other texts) go by hash, null ids come last; a sole document is its own next.
Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import WORD_BREAKS, stage

MAX_WEIGHT = 16
WORDS = 2
WORD = 64
RADIUS = 6
BLOCKS = 8  # 28 tables, keyed by 32 bits
BUCKET = 4096
LANES = (1 << 32) + 1  # bits 0 and 32
LOW = (1 << 32) - 1
RANGE_BITS = 33  # monotonically_increasing_id: a task's own count is in the low 33 bits


def signed(mask: int) -> int:
    return mask - (1 << WORD) if mask >> (WORD - 1) else mask


def votes(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """keys and ``fp`` (array of two longs) of every row; no shuffle if the rows lie together
    by some of the keys already."""
    split = texts.withColumn("_ws", F.array_remove(F.split(F.lower(text_col), WORD_BREAKS, -1), ""))
    pairs = F.arrays_zip(F.col("_ws").alias("a"), F.slice("_ws", 2, F.greatest(F.size("_ws"), F.lit(1))).alias("b"))
    terms = split.select(*keys, (F.size("_ws") < 2).alias("_one"), F.inline_outer(pairs))
    terms = terms.toDF(*keys, "_one", "_a", "_b").filter("_one OR _b IS NOT NULL")
    length = F.char_length("_a") + F.coalesce(F.char_length("_b"), F.lit(0))
    weighed = terms.select(
        *keys,
        *[F.xxhash64(F.lit(i), "_a", "_b").alias(f"_h{i}") for i in range(WORDS)],
        F.when(F.col("_a").isNull(), 0).otherwise(F.least(length, F.lit(MAX_WEIGHT))).cast("long").alias("_w"),
    )
    lane = [
        F.sum(F.shiftrightunsigned(f"_h{i}", k).bitwiseAND(F.lit(LANES)) * F.col("_w")).alias(f"_v{i}_{k}")
        for i in range(WORDS)
        for k in range(WORD // 2)
    ]
    sums = weighed.groupBy(*keys).agg(F.sum("_w").alias("_all"), *lane)
    return sums.select(*keys, F.array(*[_majority(i) for i in range(WORDS)]).alias("fp"))


def _majority(i: int) -> Column:
    bits = []
    for k in range(WORD // 2):
        v = F.col(f"_v{i}_{k}")
        for at, count in ((k, v.bitwiseAND(F.lit(LOW))), (k + 32, F.shiftrightunsigned(v, 32))):
            bits.append(F.when(2 * count > F.col("_all"), F.lit(signed(1 << at))).otherwise(F.lit(0).cast("long")))
    while len(bits) > 1:  # a balanced tree of ORs
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return bits[0]


def hexed(fp: Column) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(fp[i])), WORD // 4, "0") for i in range(WORDS)])


def distance(a: Column, b: Column) -> Column:
    """Hamming distance."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, WORDS)), F.bit_count(a[0].bitwiseXOR(b[0])))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / float(WORDS * WORD)


def masks(radius: int, blocks: int) -> list[list[int]]:
    """The bits, word by word, of every choice of blocks - radius out of ``blocks`` even blocks."""
    bits = WORDS * WORD
    if not 0 <= radius < blocks <= bits:
        raise ValueError(f"radius must be below the number of blocks, and blocks at most {bits}")
    edges = [bits * k // blocks for k in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    word = (1 << WORD) - 1
    return [[sum(c) >> (WORD * i) & word for i in range(WORDS)] for c in combinations(block, blocks - radius)]


def near(points: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """(fp, other) for all two different fingerprints of points.fp (each there once) that are
    at most ``radius`` bits apart, both ways round."""
    tables = masks(radius, blocks)

    def shared(fp: Column, m: list[int]) -> Column:
        return F.xxhash64(*[fp[i].bitwiseAND(F.lit(signed(m[i]))) for i in range(WORDS) if m[i]])

    keyed = points.select("fp", F.posexplode(F.array(*[shared(F.col("fp"), m) for m in tables])).alias("t", "key"))
    hot = keyed.groupBy("t", "key").agg(F.ceil(F.count("*") / bucket).alias("parts")).filter("parts > 1")
    split = keyed.join(hot, ["t", "key"], "left").select("fp", "t", "key", F.coalesce("parts", F.lit(1).cast("long")).alias("parts"))
    dealt = split.select("t", "key", F.col("fp").alias("other"), F.pmod(F.xxhash64("fp"), F.col("parts")).alias("part"))
    everywhere = split.select("fp", "t", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    apart = [F.col("fp")[i].bitwiseXOR(F.col("other")[i]) for i in range(WORDS)]
    first = F.lit(len(tables))
    for t in range(len(tables) - 1, -1, -1):
        agree = [apart[i].bitwiseAND(F.lit(signed(m))) == 0 for i, m in enumerate(tables[t]) if m]
        first = F.when(reduce(and_, agree), t).otherwise(first)
    met = everywhere.join(dealt, ["t", "key", "part"])
    return met.filter(distance(F.col("fp"), F.col("other")).between(1, radius) & (first == F.col("t"))).select("fp", "other")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.select(F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "id", "text").alias("k2"), "id", "text")


def _links(keyed: DataFrame) -> DataFrame:
    """Every document once: k1, k2, id, n_chars, copies, and the key of the next one, by
    falling id and round from the last to the first."""
    narrow = keyed.select("k1", "k2", "id", F.char_length("text").cast("long").alias("n")).groupBy("k1", "k2")
    order = [F.col("id").desc_nulls_last(), "k1", "k2"]
    placed = stage(
        narrow.agg(F.max("id").alias("id"), F.max("n").alias("n"), F.count("*").alias("copies"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "fingerprint-order",
    ).withColumn("range", F.shiftright("at", RANGE_BITS))
    # one row a range
    before = placed.groupBy("range").agg(F.count("*").alias("m")).selectExpr(
        "range", "sum(m) OVER (ORDER BY range) - m AS before", "sum(m) OVER () AS total"
    )
    nth = placed.join(before, "range").withColumn("nth", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << RANGE_BITS) - 1)))
    following = nth.select(F.expr("pmod(nth - 1, total)").alias("nth"), F.col("k1").alias("d1"), F.col("k2").alias("d2"))
    return nth.select("k1", "k2", "id", "n", "copies", "nth").join(following, "nth").drop("nth")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, texts): the documents' order, staged, and for each k1, k2 its ``text`` and its
    ``edited`` text; texts lie together by k1, k2."""
    keyed = _keyed(docs, id_col, text_col)
    links = stage(_links(keyed), "fingerprint-links")
    # copies of a row meet in the task that reads them, before any text moves
    whole = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    wanted = links.select(F.col("d1").alias("k1"), F.col("d2").alias("k2"), F.col("k1").alias("r1"), F.col("k2").alias("r2"), "n")
    heads = whole.join(wanted, ["k1", "k2"]).select(
        F.col("r1").alias("k1"), F.col("r2").alias("k2"), "n", F.expr("left(text, cast(n div 3 as int))").alias("head")
    )
    stays = F.expr("left(text, cast(n - n div 3 as int))")
    return links, whole.join(heads, ["k1", "k2"]).select("k1", "k2", "text", F.concat(stays, "head").alias("edited"))


def fingerprint(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (shares of equal bits), class_id (smallest id of the same
    fingerprint) and n_links (other fingerprints at most ``radius`` bits away)."""
    links, texts = edited(docs, id_col, text_col)
    hashed = texts.select("k1", "k2", F.unhex(F.sha2("edited", 256)).alias("sha"), "text", "edited")
    two = F.array(F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))
    both = hashed.select("k1", "k2", "sha", F.inline(two))
    prints = votes(both, ["k1", "k2", "sha", "which"], "text")
    one = prints.groupBy("k1", "k2", "sha").agg(
        F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("efp")
    )
    known = stage(one.join(links, ["k1", "k2"]), "fingerprints")
    classes = stage(known.groupBy("fp").agg(F.min("id").alias("class_id")), "fingerprint-classes")
    counted = near(classes, radius, blocks).groupBy("fp").agg(F.count("*").alias("n_links"))
    following = known.select(F.col("k1").alias("d1"), F.col("k2").alias("d2"), F.col("fp").alias("next_fp"))
    found = known.join(following, ["d1", "d2"]).join(classes, "fp").join(counted, "fp", "left")
    rows = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_chars"),
        F.lower(F.hex("sha")).alias("edited_sha256"),
        hexed(F.col("fp")).alias("fingerprint"),
        hexed(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "class_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
