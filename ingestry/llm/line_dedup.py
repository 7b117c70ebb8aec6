"""Operator 4, line dedup (native): winnowing over line hashes.

The lines with a word in them, in order, are a document's sequence; a line weighs its
words. A window is the shortest stretch of lines of at
least ``min_words`` words that begins, or that ends, at a line. In each window the line of
the smallest hash is its fingerprint, so a repeated stretch of lines of min_words words or
more has the same fingerprints in each place (the winnowing guarantee).

1. Every window is staged with a 128-bit hash of its lines. Windows whose fingerprint's line
   hash occurs once are dropped; that only prefilters, as equal windows have equal minima.
2. The whole-window hashes decide: equal ones are copies. No fingerprint positions are joined
   and no match is extended. Together those windows are just the repeated run, whichever copy
   shares the most with it, and no pairs of copies are built.
3. A window that occurs earlier (in a document of smaller id, or further up) is deleted;
   overlapping ones merge into runs. The first occurrence of every window stays.

Rows are keyed by id and text hash; only line hashes, positions and counts are shuffled,
and one join brings the runs back to the texts. Minima and counts are pre-aggregated, so a
line that a third of all rows share is no hot task.

Edge cases: a null or empty text has no lines and stays as it is; lines without a word
never count and go only inside a deleted run; rows with equal id and equal text are one
document, all returned alike; a null id sorts first; extra columns are kept by ``dedup``;
a run that overlaps its own earlier copy loses all but its beginning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingestry.llm.common import HAS_WORD, n_words, stage

MIN_WORDS = 50


def _lines(docs: DataFrame) -> DataFrame:
    """docs (_id, _text) -> (id, th, pos, h, h2, n): one row per line with a word, where h
    and h2 hash the line and n is its weight."""
    lines = docs.select(
        F.col("_id").alias("id"), F.xxhash64("_text").alias("th"), F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line")
    )
    return lines.filter(F.col("line").rlike(HAS_WORD)).select(
        "id", "th", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"), n_words(F.col("line")).cast("long").alias("n")
    )


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(id, th, first, last, h, w1, w2): every complete window, its fingerprint's line hash
    and the 128-bit hash of its lines."""
    doc = Window.partitionBy("id", "th")
    upto = F.sum("n").over(doc.orderBy("pos"))
    lines = lines.distinct().withColumn("before", upto - F.col("n")).withColumn("upto", upto)
    found = []
    for order, low, high in (("before", 0, min_words - 1), ("upto", 1 - min_words, 0)):
        near = doc.orderBy(order).rangeBetween(low, high)
        found.append(
            lines.select(
                "id",
                "th",
                F.min("pos").over(near).alias("first"),
                F.max("pos").over(near).alias("last"),
                F.sum("n").over(near).alias("words"),
                F.min(F.struct("h", "h2", "pos")).over(near).alias("mark"),
                F.xxhash64(F.collect_list("h").over(near)).alias("w1"),
                F.xxhash64(F.collect_list("h2").over(near)).alias("w2"),
            )
        )
    both = found[0].union(found[1]).filter(F.col("words") >= min_words)
    return both.select("id", "th", "first", "last", "mark", "w1", "w2").distinct()


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, runs): the maximal runs of lines to delete, as array<struct<first, last>> of
    line numbers from 0, for each document (id and text hash) that has any."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    windows = stage(_windows(_lines(rows), min_words), "line-windows")
    marks = windows.select("id", "th", "mark").distinct()
    met = marks.groupBy("mark.h", "mark.h2").agg(F.count("*").alias("c")).filter("c > 1").select("h", "h2")
    matched = windows.withColumns({"h": F.col("mark.h"), "h2": F.col("mark.h2")}).join(met, ["h", "h2"], "left_semi")
    # Line numbers of a window's copies differ with lines that have no word; ids decide.
    first = matched.groupBy("w1", "w2").agg(F.min(F.struct("id", "th", "first")).alias("earliest"), F.count("*").alias("c"))
    later = matched.join(first.filter("c > 1"), ["w1", "w2"]).filter(
        ~F.struct("id", "th", "first").eqNullSafe(F.col("earliest"))
    )
    doc = Window.partitionBy("id", "th").orderBy("first", "last")
    reach = F.max("last").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    # A run ends where the next window doesn't touch it.
    islands = (
        later.select("id", "th", "first", "last")
        .withColumn("new", F.when(F.col("first") <= reach + 1, 0).otherwise(1))
        .withColumn("run", F.sum("new").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    )
    runs = islands.groupBy("id", "th", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_counts: bool = False,
) -> DataFrame:
    """docs with later repeated runs gone from the text, all input columns kept (n_chars,
    where there is one, follows the text); ``with_counts`` adds n_lines, n_removed, n_runs."""
    runs = repeated_runs(docs, min_words, id_col, text_col)
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"))
    joined = rows.join(runs, rows["_id"].eqNullSafe(runs["id"]) & (rows["_th"] == runs["th"]), "left").select("_row", "runs")
    text = F.col("_row")[text_col]
    cut = joined.withColumn("ls", F.when(F.col("runs").isNotNull(), F.split(text, "\n", -1)))
    # What stands between two runs, before the first and after the last.
    kept = F.expr(
        "flatten(transform(array_append(runs, named_struct('first', size(ls), 'last', size(ls))), (r, i) -> "
        "slice(ls, coalesce(get(runs, i - 1).last, -1) + 2, r.first - coalesce(get(runs, i - 1).last, -1) - 1)))"
    )
    new = F.when(F.col("runs").isNull(), text).otherwise(F.array_join(kept, "\n"))
    cut = cut.withColumn("_new", new)
    own = {text_col: F.col("_new")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.char_length("_new").cast(docs.schema["n_chars"].dataType)
    out = [own.get(c, F.col("_row")[c]).alias(c) for c in docs.columns]
    if with_counts:
        gone = F.expr("coalesce(aggregate(runs, 0L, (s, r) -> s + r.last - r.first + 1), 0L)")
        n_lines = F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(F.size(F.split(text, "\n", -1)))
        out += [
            n_lines.cast("long").alias("n_lines"),
            gone.alias("n_removed"),
            F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"),
        ]
    return cut.select(*out)
