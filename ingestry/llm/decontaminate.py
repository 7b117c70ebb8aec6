"""Operator 7, benchmark decontamination: BM25 inverted index with block-max WAND.

The test items are the index: postings of BM25 impacts, in blocks of ``BLOCK_ITEMS`` items
with their largest impact. An impact is divided by the item's score against itself, so 1.0
means that every word of the item is there. Every passage of every document is a query: a
window of two strides, a stride being the words of the longest item, so each stretch of that
many words lies whole in some window. Block maxima rule out, for a whole batch at once, the
blocks that can't reach the threshold; block-max WAND retrieves all items at or above it
among what is left, and each is verified: the passage must hold enough of the item's
question and of its answer, as word n-grams.

The index goes to the tasks by broadcast in shards of items of at most ``INDEX_BYTES`` of
text; a larger benchmark takes several passes over the documents, with the same statistics.

Edge cases: null and empty texts hold no passage; items without words find nothing; an item
of one sentence is its own question and answer; repeated rows and repeated items are
reported each; null item ids stay null; other columns are ignored; an empty benchmark or
table gives an empty result; texts are searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
THRESHOLD = 0.7  # share of an item's own score that a passage must reach
OVERLAP = 0.8  # share of the question's, and of the answer's, n-grams in the passage
GRAM = 5
BLOCK_ITEMS = 8
MIN_STRIDE = 32
INDEX_BYTES = 16_000_000
CELLS = 2_000_000  # (half window, block) bounds in memory at once


def words_of(text: str | None) -> list[str]:
    import re

    return re.findall(r"\w+", (text or "").lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer: the last line, or the last sentence of a
    single line, is the answer. Items of one sentence are both."""
    import re

    parts = [p for p in text.split("\n") if words_of(p)]
    if len(parts) < 2:
        parts = [p for p in re.split(r"(?<=[.!?])\s+", text) if words_of(p)]
    if len(parts) < 2:
        return words_of(text), words_of(text)
    return words_of("\n".join(parts[:-1])), words_of(parts[-1])


def grams(words: list[str], n: int = GRAM) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Block-max inverted index of one shard of items."""

    def __init__(self, items: list[tuple], n_items: int, mean_words: float, df: dict[str, int]):
        import math
        from collections import Counter

        import numpy as np

        self.items = [item for item, _ in items]
        texts = [words_of(text) for _, text in items]
        pairs = [question_answer(text or "") for _, text in items]
        self.gram_sizes = [(min(GRAM, len(q)), min(GRAM, len(a))) for q, a in pairs]
        self.grams = [(grams(q), grams(a)) for q, a in pairs]
        postings: dict[str, list[tuple[int, float]]] = {}
        for k, words in enumerate(texts):
            norm = K1 * (1 - B + B * len(words) / max(mean_words, 1e-9))
            impacts = {
                w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1) / (c + norm)
                for w, c in Counter(words).items()
            }
            total = sum(impacts.values())
            for w, x in impacts.items():
                postings.setdefault(w, []).append((k, x / total))
        self.terms = {w: t for t, w in enumerate(postings)}
        self.lists = [([k for k, _ in p], [x for _, x in p]) for p in postings.values()]
        self.n_blocks = -(-len(items) // BLOCK_ITEMS)
        self.block_max: list[dict[int, float]] = []
        starts, blocks, tops = [0], [], []
        for at, xs in self.lists:
            most: dict[int, float] = {}
            for k, x in zip(at, xs):
                most[k // BLOCK_ITEMS] = max(x, most.get(k // BLOCK_ITEMS, 0.0))
            self.block_max.append(most)
            blocks += most.keys()
            tops += most.values()
            starts.append(len(blocks))
        self.tops = [max(xs) for _, xs in self.lists]
        self.starts = np.array(starts, dtype=np.int64)
        self.blocks = np.array(blocks, dtype=np.int64)
        self.bounds = np.array(tops, dtype=np.float64)

    def half_bounds(self, halves, terms, n_halves: int):
        """(n_halves x blocks): the most that a half window's terms can add to any item of a
        block. halves, terms: parallel arrays, distinct pairs."""
        import numpy as np

        counts = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        cells = np.repeat(halves, counts) * self.n_blocks + self.blocks[at]
        return np.bincount(cells, weights=self.bounds[at], minlength=n_halves * self.n_blocks).reshape(n_halves, -1)

    def search(self, terms: list[int], threshold: float, blocks: list[int]) -> list[tuple[int, float]]:
        """All items of the blocks that score at least the threshold, by block-max WAND."""
        import bisect

        found = []
        for block in blocks:
            first, last = block * BLOCK_ITEMS, (block + 1) * BLOCK_ITEMS
            cursors = []
            for t in terms:
                most = self.block_max[t].get(block)
                if most is not None:
                    at, xs = self.lists[t]
                    cursors.append([at[p := bisect.bisect_left(at, first)], p, most, at, xs])
            while cursors:
                cursors.sort(key=lambda c: c[0])
                bound, pivot = 0.0, None
                for k, c in enumerate(cursors):
                    bound += c[2]
                    if bound >= threshold - 1e-9:
                        pivot = k
                        break
                if pivot is None:
                    break
                item = cursors[pivot][0]
                if cursors[0][0] == item:
                    score = sum(c[4][c[1]] for c in cursors if c[0] == item)
                    if score >= threshold - 1e-9:
                        found.append((item, score))
                    target = item + 1
                else:
                    target = item
                for c in cursors:
                    if c[0] < target:
                        c[1] = bisect.bisect_left(c[3], target, c[1])
                        c[0] = c[3][c[1]] if c[1] < len(c[3]) else last
                cursors = [c for c in cursors if c[0] < last]
        return found

    def verified(self, k: int, words: list[str], overlap: float) -> tuple[float, float] | None:
        """Shares of item k's question and answer n-grams in the passage, if both suffice."""
        shares = []
        for own, n in zip(self.grams[k], self.gram_sizes[k]):
            there = grams(words, n) if len(words) >= n else set()
            shares.append(len(own & there) / len(own))
            if shares[-1] < overlap:
                return None
        return shares[0], shares[1]


def _finder(index, stride: int, threshold: float, overlap: float, id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        ix = index.value
        known, term = set(ix.terms), ix.terms.__getitem__

        def matches(docs):
            """docs: (id, words). One row per document and item: the best passage."""
            first, terms, counts = [], [], []
            for _, words in docs:
                first.append(len(counts))
                for i in range(0, len(words), stride):
                    own = known.intersection(words[i : i + stride])
                    terms += map(term, own)
                    counts.append(len(own))
            n = len(counts)
            halves = np.repeat(np.arange(n), counts)
            bounds = ix.half_bounds(halves, np.array(terms, dtype=np.int64), n)
            pair = bounds.copy()
            pair[:-1] += bounds[1:]
            last = np.array([*first[1:], n]) - 1
            pair[last] = bounds[last]  # a document's last half stands alone
            hit = np.flatnonzero((pair >= threshold - 1e-9).any(axis=1))
            owner = np.searchsorted(np.array(first), hit, side="right") - 1
            best: dict[tuple[int, int], tuple] = {}
            for h, d in zip(hit.tolist(), owner.tolist()):
                start = (h - first[d]) * stride
                passage = docs[d][1][start : start + 2 * stride]
                query = list(map(term, known.intersection(passage)))
                for k, score in ix.search(query, threshold, np.flatnonzero(pair[h] >= threshold - 1e-9).tolist()):
                    if (d, k) in best and best[d, k][0] >= score:
                        continue
                    shares = ix.verified(k, passage, overlap)
                    if shares:
                        best[d, k] = (score, *shares)
            for (d, k), row in best.items():
                yield (docs[d][0], ix.items[k], *row)

        for batch in batches:
            docs, cells, rows = [], 0, []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if words:
                    docs.append((doc, words))
                    cells += (len(words) // stride + 1) * ix.n_blocks
                if cells > CELLS:
                    rows += matches(docs)
                    docs, cells = [], 0
            if docs:
                rows += matches(docs)
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], type=id_type[0]), pa.array(cols[1], type=id_type[1]), *(pa.array(c, type=pa.float64()) for c in cols[2:])],
                    names=["_id", "_item", "score", "question_overlap", "answer_overlap"],
                )

    return run


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per document and item found in it: id, item, score, question_overlap,
    answer_overlap (of the best passage)."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    id_kind, item_kind = docs.schema[id_col].dataType, items.schema[item_col].dataType
    id_type = (to_arrow_type(id_kind), to_arrow_type(item_kind))
    schema = (
        f"_id {id_kind.simpleString()}, _item {item_kind.simpleString()}, score double, "
        "question_overlap double, answer_overlap double"
    )
    named = items.select(F.col(item_col).alias("_item"), F.col(item_text).alias("_text")).filter("_text is not null")

    def counted(batches):
        for batch in batches:
            found = [words_of(t) for t in batch.column(0).to_pylist()]
            flat = [(w, len(ws) if k == 0 else None) for ws in found for k, w in enumerate(sorted(set(ws)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in flat], type=pa.string()), pa.array([n for _, n in flat], type=pa.int64())],
                names=["word", "n_words"],
            )

    # One row per item carries its length; the others are null.
    words = named.select("_text").mapInArrow(counted, "word string, n_words long")
    total = words.agg(F.count("n_words").alias("n"), F.sum("n_words").alias("s"), F.max("n_words").alias("m")).first()
    bytes_ = named.agg(F.sum(F.octet_length("_text")).alias("b")).first()["b"] or 0
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_text is not null")
    out = spark.createDataFrame([], schema)
    if not total["n"]:
        return _named(out, id_col, item_col)
    shards = -(-bytes_ // index_bytes)
    place = F.pmod(F.xxhash64("_text", "_item"), F.lit(shards))
    stride = max(MIN_STRIDE, total["m"])
    for k in range(shards):
        own = named.filter(place == k)
        vocabulary = own.select("_text").mapInArrow(counted, "word string, n_words long").select("word").distinct()
        df = words.groupBy("word").agg(F.count("*").alias("df"))
        df = df if shards == 1 else df.join(vocabulary, "word", "left_semi")
        # Bounded: the words and the items of one shard of at most about index_bytes.
        frequencies = {r["word"]: r["df"] for r in df.collect()}
        shard = [(r["_item"], r["_text"]) for r in own.orderBy("_item", "_text").collect() if words_of(r["_text"])]
        if not shard:
            continue
        index = spark.sparkContext.broadcast(Index(shard, total["n"], total["s"] / total["n"], frequencies))
        found = rows.mapInArrow(_finder(index, stride, threshold, overlap, id_type), schema)
        out = found if k == 0 else out.union(found)
    return _named(out, id_col, item_col)


def _named(found: DataFrame, id_col: str, item_col: str) -> DataFrame:
    return found.withColumnsRenamed({"_id": id_col, "_item": item_col})
