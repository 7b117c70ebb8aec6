"""Operator 10, license scans (native): ordered signature rules.

A text is worth scanning if one of the keywords is among its words. Its words are then
lower-cased (A-Z only) and set as ' w ', and each rule whose keyword occurs is matched.
Detections are resolved by interval containment: one that lies inside another is dropped,
and of several with the same span the rule of higher priority stays. Partial overlaps
both stay, as they are evidence for different rules. One projection per document: no
shuffle, no Python.

Edge cases: a null text counts as empty; a text without words has no places, labels "" and
score 0; repeated rows are scanned row by row; other columns of the input are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import settled
from ingestry.llm.license_rules import BASE_PHRASES, BASE_WEIGHT, gate_words, rules

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, listed singly: a list is one lookup, a range a call
WORD = "[^" + "".join(rf"\x{c:02X}" for c in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))) + "]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPAN = "array<struct<b:int,ne:int,o:int,l:string,c:double>>"


def _places(words: tuple[str, ...]) -> str:
    """SQL: word positions where the phrase stands in the word array w."""
    same = " and ".join(f"get(w, i + {k}) <=> '{x}'" if k else f"x = '{x}'" for k, x in enumerate(words))
    return f"transform(filter(transform(w, (x, i) -> named_struct('i', i, 'y', {same})), z -> z.y), z -> z.i)"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score and
    ``detections`` (label, rule, first and last word of each kept detection)."""
    table = f"from_json('{json.dumps(rules())}', 'array<struct<k:string,p:string,l:string,o:int,c:double>>')"
    df = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # lower() may change letters beyond A-Z, but no word's bounds and no keyword's spelling:
    # good for counting and for the gate, while the rules read the A-Z form.
    df = df.select("_id", F.regexp_extract_all(F.lower("t"), F.lit(WORD), F.lit(0)).alias("w"), "t")
    gate = F.array(*(F.lit(k) for k in gate_words()))
    df = df.select("_id", F.size("w").cast("long").alias("n_words"), F.arrays_overlap("w", gate).alias("hit"), "t")
    words = F.regexp_extract_all(F.translate("t", UPPER, LOWER), F.lit(WORD), F.lit(0))
    none = F.expr("cast(array() as array<string>)")
    df = df.select("_id", "n_words", F.when(F.col("hit"), words).otherwise(none).alias("w"))
    df = df.select("_id", "n_words", "w", F.concat(F.lit(" "), F.array_join("w", "  "), F.lit(" ")).alias("t"))
    spans = f"""
      if(size(w) = 0, cast(array() as {SPAN}), flatten(transform(
        transform(filter({table}, r -> contains(t, r.k)), r ->
          named_struct('r', r, 'm', regexp_extract_all(t, r.p, 0), 's', split(t, r.p, -1))),
        h -> aggregate(
          transform(h.m, (x, i) -> i),
          named_struct('at', 0, 'out', cast(array() as {SPAN})),
          (a, i) -> named_struct(
            'at', a.at + char_length(h.s[i]) + char_length(h.m[i]),
            'out', array_append(a.out, named_struct(
              'b', a.at + char_length(h.s[i]), 'ne', -(a.at + char_length(h.s[i]) + char_length(h.m[i])),
              'o', h.r.o, 'l', h.r.l, 'c', h.r.c))),
          a -> a.out))))"""
    kept = f"""
      aggregate(sort_array(spans), cast(array() as {SPAN}),
        (a, d) -> if(get(a, size(a) - 1).ne <= d.ne, a, array_append(a, d)))"""
    before = "cast((char_length(left(t, {0})) - char_length(replace(left(t, {0}), ' ', ''))) / 2 as int)"
    base = {label: F.expr(_places(phrase)) for label, phrase in BASE_PHRASES}
    df = df.withColumn("spans", F.expr(spans)).withColumn("kept", F.expr(kept))
    df = df.select(
        "_id",
        "n_words",
        F.expr(
            f"transform(kept, d -> named_struct('label', d.l, 'rule', d.o, 'first_word', {before.format('d.b')}, "
            f"'last_word', {before.format('-d.ne')} - 1))"
        ).alias("detections"),
        F.array_sort(F.array_distinct(F.transform("kept", lambda d: d["l"]))).alias("more"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: d["c"])), F.lit(0.0)).alias("best"),
        *(places.alias(f"at_{k}") for k, places in enumerate(base.values())),
    )
    at = F.concat(*(F.col(f"at_{k}") for k in range(len(base))))
    own = F.array_compact(
        F.array(*(F.when(F.size(f"at_{k}") > 0, F.lit(label)) for k, label in enumerate(base)))
    )
    df = df.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(own, "more"))), ",").alias("labels"),
        F.greatest("best", F.when(F.size(at) > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0))).alias("score"),
        "detections",
    )
    return settled(df)
