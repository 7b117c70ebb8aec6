"""Operator 9, quality rules (native): line-first cleaning.

Every line is judged by three rules (punctuation noise, navigation bars, boilerplate
phrases). Failing lines are removed; a document that loses more than ``max_loss`` of its
bytes with them, or that fails the base limits (too few words, too many repeated 3-word
windows), is rejected. All of it is one projection per document: no shuffle, no Python.

Edge cases: a null text counts as empty; an empty text has no words and is rejected;
repeated rows are judged row by row; other columns of the input are left out of
``measure`` and kept as they are by ``clean``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import HAS_WORD, WORD_BREAKS, n_words, settled

SYMBOLS = "#*$%&|<>"
# Characters that prose uses rarely; more than one for every second word is noise.
NOISE = r"[^#*$%&<>!?=~^_{}\\\[\]]+"
# Separators of menus, breadcrumbs and link bars.
BARS = r"[^|»·]+"
BOILERPLATE = (
    r"(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)"
    r"|accept (?:all )?cookies|subscribe to|sign up for|click here|read more|share this"
    r"|skip to (?:main )?content|back to top|powered by|javascript is (?:disabled|required)"
)
BOILERPLATE_WORDS = 20
MAX_LOSS = 0.5
MIN_WORDS = 50
# Positions ride in the low bits of a window's sort key; longer texts take the exact path.
POSITION_BITS = 20


def line_fails(line: Column) -> Column:
    """True if any of the three line rules removes the line."""
    noise = F.char_length(F.regexp_replace(line, NOISE, ""))
    bars = F.char_length(F.regexp_replace(line, BARS, ""))
    words = n_words(line)
    return (
        (2 * noise > words)
        | ((bars >= 3) & (4 * bars >= words))
        | ((words <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))
    )


def _repeat_columns(df: DataFrame, exact: bool) -> DataFrame:
    """Column ``n_repeat_words`` from the word array ``w``.

    Each window's key is its hash above its position; sorting the keys brings equal
    windows together. Equal hashes are compared word by word, and a text with a collision
    (or with more words than positions fit) is sorted by the windows themselves.
    """
    b, mask = POSITION_BITS, (1 << POSITION_BITS) - 1
    heads = "slice(w, 1, greatest(size(w) - 2, 0))"
    same = "shiftright(x, {b}) <=> shiftright(get({a}, k - 1), {b})"
    df = df.withColumn(
        "wk",
        F.expr(
            f"if(size(w) > {mask}, cast(array() as array<bigint>), sort_array(transform({heads}, (x, i) -> "
            f"shiftleft(shiftright(xxhash64(x, get(w, i + 1), get(w, i + 2)), {b}), {b}) | cast(i as bigint))))"
        ),
    )
    df = df.withColumn(
        "wr",
        F.expr(
            f"filter(wk, (x, k) -> {same.format(b=b, a='wk')} "
            f"or shiftright(x, {b}) <=> shiftright(get(wk, k + 1), {b}))"
        ),
    )
    p, q = f"cast(x & {mask} as int)", f"cast(get(wr, k - 1) & {mask} as int)"
    differ = " or ".join(f"get(w, {p} + {o}) != get(w, {q} + {o})" for o in range(3))
    collides = f"size(filter(wr, (x, k) -> {same.format(b=b, a='wr')} and ({differ}))) > 0"
    if exact:
        collides = "true"
    slow = (
        f"get(transform(array(sort_array(transform({heads}, (x, i) -> "
        "named_struct('s', concat_ws(' ', x, get(w, i + 1), get(w, i + 2)), 'p', i)))), e -> "
        "sort_array(transform(filter(e, (x, k) -> x.s <=> get(e, k - 1).s or x.s <=> get(e, k + 1).s), x -> x.p))), 0)"
    )
    fast = f"sort_array(transform(wr, x -> cast(x & {mask} as int)))"
    df = df.withColumn("wp", F.expr(f"if(size(w) > {mask} or {collides}, {slow}, {fast})"))
    return df.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(wp, named_struct('last', -3, 'n', 0L), "
            "(a, x) -> named_struct('last', x, 'n', a.n + least(3, x - a.last)), a -> a.n)"
        ),
    ).drop("wk", "wr", "wp")


def _measured(rows: DataFrame, max_loss: float, exact: bool) -> DataFrame:
    """rows: (_row struct, t text). Adds the measures, the cleaned text and the verdict."""
    df = rows.select(
        "_row",
        "t",
        F.array_remove(F.split("t", WORD_BREAKS, -1), "").alias("w"),
        F.split("t", "\n", -1).alias("ls"),
    )
    df = _repeat_columns(df, exact)
    lined = F.filter("ls", lambda x: x.rlike(HAS_WORD))
    df = df.select(
        "_row",
        "t",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.octet_length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lined.alias("lw"),
        "n_repeat_words",
        F.array_join(F.filter("ls", lambda x: ~line_fails(x)), "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    enough = F.octet_length("cleaned") >= (1 - max_loss) * F.octet_length("t")
    df = df.select(
        "_row",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lw") - F.size(F.array_distinct("lw"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
        "cleaned",
    )
    return settled(df)


def _rows(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_loss: float = MAX_LOSS, exact: bool = False
) -> DataFrame:
    """One row per document: id, the measures, base_failed, kept and the cleaned text.

    ``exact`` sorts the windows themselves for every text (for tests of that path)."""
    out = _measured(_rows(docs.select(id_col, text_col), text_col), max_loss, exact)
    return out.select(F.col("_row")[id_col].alias(id_col), *out.columns[1:])


def clean(docs: DataFrame, text_col: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """The kept documents, all input columns, with failing lines gone from the text;
    n_chars, where there is one, follows the new text."""
    out = _measured(_rows(docs, text_col), max_loss, False).filter("kept")
    new = {text_col: F.col("cleaned")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("cleaned").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))
