"""Operator 3, toxicity: gradient-boosted trees over dense features, isotonic calibration.

Labels are learned from about ``TRAIN_ROWS`` labelled documents outside the held-out fifth
(crc32 of the id as text, mod 5), and at least ``RARE_ROWS`` of either label where there are
so many; calibration weighs a label back that was drawn more often than the other. Three of the remaining four parts teach the lexicon (words
and word beginnings that mark toxic documents, by smoothed log odds) and the trees; the
fourth calibrates the margin by isotonic regression. Features are densities of lexicon words
and beginnings, their nearness to second-person words, and rates of capitals, marks and
obfuscated words (letters mixed with digits or symbols, stretched letters). Scoring reads
the text only.

Edge cases: null and empty texts have all features zero and get a score like any other; a
null id isn't held out; labels that are null are no labels, repeated ones count once; with
labels of one kind only, or none, every score is their (smoothed) share; repeated rows are
scored row by row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import chosen, stage

TRAIN_ROWS = 20_000  # labelled documents, about, that lexicon, trees and calibration see
LEXICON_TERMS = 4_000
RARE_ROWS = 1_000  # of each label, that the draw keeps at least, if there are so many
MIN_TOXIC = 3  # toxic documents that a lexicon term must occur in
MIN_LOG_ODDS = 1.5
PREFIXES = (4, 5, 6)
SEEN_WORDS = 300_000  # words a task remembers its judgement of
NEAR = 5  # words between a lexicon word and a second-person word
TREES, DEPTH, STEP = 20, 3, 0.25
TIE = 1e-3  # weight of the trees' own probability, which orders equal calibrated scores

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro"
).split()
# Characters that stand for letters.
LEET = {"@": "a", "4": "a", "3": "e", "1": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
FEATURES = (
    "log_words",
    "word_density",
    "prefix_density",
    "weight_density",
    "top_weight",
    "log_hits",
    "near_density",
    "near_share",
    "second_person",
    "capitals",
    "exclamations",
    "questions",
    "punctuation",
    "symbols",
    "obfuscated",
    "obfuscated_hits",
)


def words_of(text: str) -> list[str]:
    import re

    return re.findall(r"[^\s.,;:!?\"'()\[\]|]+", text.lower())


def terms_of(words: set[str]) -> set[str]:
    """Lexicon terms of a set of words: =word, and ^beginning of longer words."""
    found = {"=" + w for w in words if len(w) <= 40}
    for n in PREFIXES:
        found.update("^" + w[:n] for w in words if len(w) > n)
    return found


class Marker:
    """Says of each word what the features need; remembers the words it has judged."""

    def __init__(self, terms: dict[str, float]):
        self.exact = {t[1:]: x for t, x in terms.items() if t[0] == "="}
        self.begins = {t[1:]: x for t, x in terms.items() if t[0] == "^"}
        self.second = set(SECOND_PERSON)
        self.unmask = str.maketrans(LEET)
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[bool, float]] = {}  # word: is it a beginning, its log odds
        self.odd: dict[str, bool] = {}  # obfuscated word: is its plain form in the lexicon

    def judge(self, words: set[str]) -> None:
        import re

        if len(self.seen) > SEEN_WORDS:
            self.seen, self.hits, self.odd = set(), {}, {}
        for w in words - self.seen:
            if w in self.exact:
                self.hits[w] = (False, self.exact[w])
                continue
            begun = [self.begins[w[:k]] for k in PREFIXES if len(w) > k and w[:k] in self.begins]
            if begun:
                self.hits[w] = (True, max(begun))
            elif len(w) > 2 and any(map(str.isalpha, w)) and (not w.isalpha() or re.search(r"(.)\1\1", w)):
                plain = re.sub(r"(.)\1{2,}", r"\1", w.translate(self.unmask))
                if plain != w:
                    self.odd[w] = plain in self.exact
        self.seen |= words

    def features(self, text: str) -> list[float]:
        import re

        words = words_of(text)
        distinct = set(words)
        self.judge(distinct)
        n = max(1, len(words))
        hits, begun, top, weight = [], 0, 0.0, 0.0
        if not self.hits.keys().isdisjoint(distinct):
            for i, w in enumerate(words):
                if w in self.hits:
                    start, x = self.hits[w]
                    hits.append(i)
                    begun += start
                    weight += x
                    top = max(top, x)
        odd = odd_hits = 0
        if not self.odd.keys().isdisjoint(distinct):
            odd = sum(w in self.odd for w in words)
            odd_hits = sum(self.odd.get(w, False) for w in words)
        you = [] if self.second.isdisjoint(distinct) else [i for i, w in enumerate(words) if w in self.second]
        near, j = 0, 0
        for i in hits:
            while j + 1 < len(you) and you[j + 1] <= i:
                j += 1
            near += any(abs(p - i) <= NEAR for p in you[j : j + 2])
        chars = max(1, len(text))
        marks = {c: text.count(c) for c in "!?.,;:#*$%&|<>@"}
        return [
            math.log1p(len(words)),
            (len(hits) - begun) / n,
            begun / n,
            weight / n,
            top,
            math.log1p(len(hits)),
            near / n,
            near / max(1, len(hits)),
            len(you) / n,
            sum(map(len, re.findall(r"[A-ZÀ-ÖØ-Þ]+", text))) / chars,
            marks["!"] / n,
            marks["?"] / n,
            sum(marks[c] for c in "!?.,;:") / chars,
            sum(marks[c] for c in "#*$%&|<>@") / chars,
            odd / n,
            odd_hits / n,
        ]


def _bucket(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def lexicon(train: DataFrame) -> dict[str, float]:
    """train (text, label) -> term to log odds, at most LEXICON_TERMS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in batches:
            toxic, all_ = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms_of(set(words_of(text or "")))
                all_.update(found)
                if label:
                    toxic.update(found)
            # a term that is never toxic can't enter the lexicon
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(all_)), pa.array([toxic[t] for t in all_], type=pa.int64()), pa.array(list(all_.values()), type=pa.int64())],
                names=["term", "toxic", "n"],
            )

    size = train.agg(F.sum("label").alias("t"), F.count("*").alias("n")).first()
    toxic_docs, clean_docs = size["t"] or 0, size["n"] - (size["t"] or 0)
    counts = train.select("text", "label").mapInArrow(run, "term string, toxic long, n long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic_docs + 1)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (clean_docs + 1))
    found = counts.filter(F.col("toxic") >= MIN_TOXIC).withColumn("odds", odds).filter(F.col("odds") >= MIN_LOG_ODDS)
    # Bounded: LEXICON_TERMS rows.
    return {r["term"]: r["odds"] for r in found.orderBy(F.desc("odds"), F.desc("toxic"), "term").limit(LEXICON_TERMS).collect()}


def with_features(rows: DataFrame, terms: dict[str, float]) -> DataFrame:
    """rows (_id, _held, text, ...) -> the columns besides text, and the features."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marker = Marker(terms)
        for batch in batches:
            found = [marker.features(t.as_py() or "") for t in batch.column("text")]
            cols = list(zip(*found)) if found else [[] for _ in FEATURES]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, type=pa.float64()) for c in cols)],
                names=[*kept, *FEATURES],
            )

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept]
    return rows.select(*kept, "text").mapInArrow(run, ", ".join([*kinds, *(f"{f} double" for f in FEATURES)]))


def _drawn(known: DataFrame, train_rows: int, rare_rows: int = RARE_ROWS) -> DataFrame:
    """About train_rows of the labelled ids, but at least rare_rows of each label (all, if there
    are fewer); ``weight`` is how many ids of its label one stands for, relative to the others."""
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    wanted = {y: min(c, max(rare_rows, c * train_rows // total)) for y, c in n.items()}
    if total <= train_rows or all(c * train_rows // total >= min(c, rare_rows) for c in n.values()):
        return chosen(known, total, train_rows, "_id").withColumn("weight", F.lit(1.0))
    parts = [
        chosen(known.filter(F.col("label") == y), c, wanted[y], "_id").withColumn("weight", F.lit(c / wanted[y]))
        for y, c in sorted(n.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """id, held_out, score, predicted, row by row."""
    held = F.coalesce(_bucket(id_col) == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("_id"), held.alias("_held"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("_id").agg(F.max("label").alias("label")).withColumn("part", _bucket("_id"))
    known = known.filter("part != 0")
    known = _drawn(known, train_rows)
    # About train_rows rows of three numbers are broadcast.
    labelled = stage(rows.join(F.broadcast(known), "_id").select("_id", "text", "label", "part", "weight"), "labelled")
    tally = {(r["fit"], r["label"]): r["n"] for r in labelled.groupBy((F.col("part") != 1).alias("fit"), "label").agg(F.count("*").alias("n")).collect()}
    if len(tally) < 4:  # a part lacks one of the two labels
        share = (sum(n for (_, y), n in tally.items() if y) + 0.5) / (sum(tally.values()) + 1) if tally else 0.0
        return _scored(rows.select("_id", "_held", F.lit(float(share)).alias("score")), id_col)
    terms = lexicon(labelled.filter("part != 1"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    known = vectors.transform(stage(with_features(labelled, terms), "features"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, cacheNodeIds=False).fit(known.filter("part != 1"))
    margin = vector_to_array("rawPrediction")[1].alias("margin")
    held_back = trees.transform(known.filter("part = 1")).select("label", margin, "weight")
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight").fit(held_back)
    scored = trees.transform(vectors.transform(with_features(rows, terms))).select(
        "_id", "_held", margin, vector_to_array("probability")[1].alias("p")
    )
    scored = curve.transform(scored)
    mixed = F.least(F.greatest((1 - TIE) * F.col("prediction") + TIE * F.col("p"), F.lit(0.0)), F.lit(1.0))
    return _scored(scored.select("_id", "_held", mixed.alias("score")), id_col)


def _scored(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_held").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
