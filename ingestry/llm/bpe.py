"""Operator 6, byte-level BPE encoding and decoding: two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves every pre-token that is a
vocabulary entry itself. Tier two: a pre-token that isn't is merged
from its bytes with a heap of candidate pairs over a linked list, so a run of n bytes takes
n log n steps. The vocabulary file is read on the driver and broadcast (its size is fixed by
the file, about 2 MB); texts are split by Spark's partitions and encoded in Arrow batches.

Edge cases: null and empty texts have no tokens and decode to no bytes; very long texts and
very long pre-tokens are encoded whole; repeated rows are encoded row by row; other columns
of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest as digest

CACHE_ENTRIES = 200_000  # resolved pre-tokens a task remembers, and as many older ones
CACHED_CHARS = 256  # longer pre-tokens are not remembered
BATCH_CHARS = 4_000_000  # input behind one output batch


class MinimalHash:
    """A minimal perfect hash by hash-and-displace: n keys in n slots. A bucket's
    displacement is the seed that spreads its keys over free slots, or, below zero, the slot
    of its only key."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.m = n, n // 2 + 1
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        for k, key in enumerate(keys):
            buckets[digest(key) % self.m].append(k)
        self.moves = [0] * self.m
        self.keys = [-1] * n  # slot -> index of its key
        free = None
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            own = buckets[b]
            if len(own) > 1:
                move = 1
                while True:
                    at = {digest(keys[k], move) % n for k in own}
                    if len(at) == len(own) and all(self.keys[s] < 0 for s in at):
                        break
                    move += 1
                self.moves[b] = move
                for k in own:
                    self.keys[digest(keys[k], move) % n] = k
            elif own:
                if free is None:
                    free = iter([s for s in range(n) if self.keys[s] < 0])
                s = next(free)
                self.moves[b] = -s - 1
                self.keys[s] = own[0]

    def find(self, key: bytes) -> int:
        """The index of the only vocabulary entry that key can be."""
        move = self.moves[digest(key) % self.m]
        return self.keys[-move - 1 if move < 0 else digest(key, move) % self.n]


class Vocabulary:
    """Ranks of a tiktoken file, with the pattern that splits texts."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
        self.pattern = pattern
        self.tokens = [token for _, token in ranked]
        self.ids = [rank for rank, _ in ranked]
        self.hash = MinimalHash(self.tokens)

    def ranks(self) -> dict[bytes, int]:
        if not hasattr(self, "_ranks"):
            self._ranks = dict(zip(self.tokens, self.ids))
        return self._ranks

    def by_id(self) -> pa.Array:
        """The bytes of every id, null where no token has it."""
        words: list[bytes | None] = [None] * (max(self.ids, default=-1) + 1)
        for k, token in zip(self.ids, self.tokens):
            words[k] = token
        return pa.array(words, type=pa.binary())

    def resolve(self, pretoken: str) -> bytes:
        """Ids of a pre-token, as packed 32-bit integers: the perfect hash first, merging
        for the rest."""
        text = pretoken.encode()
        k = self.hash.find(text)
        found = self.ids[k : k + 1] if self.tokens[k] == text else merged(text, self.ranks())
        return array("i", found).tobytes()


class Resolved(dict):
    """pre-token -> packed ids, resolved when first asked for. When full, the entries become
    the older half, and those asked for again return from there."""

    def __init__(self, resolve, limit: int = CACHE_ENTRIES):
        self.resolve, self.limit, self.older = resolve, limit, {}

    def __missing__(self, pretoken: str) -> bytes:
        if len(self) >= self.limit:
            self.older = self.copy()
            self.clear()
        found = self.older.get(pretoken)
        if found is None:
            found = self.resolve(pretoken)
        if len(pretoken) <= CACHED_CHARS:
            self[pretoken] = found
        return found


def merged(text: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges by rank, leftmost first, with a heap over linked segments.

    Segment i is text[i:end[i]]; now[i] is the rank of it joined with the next one. A heap
    entry holds a rank above a place and is stale if now[i] has another rank."""
    n = len(text)
    bits = n.bit_length()
    low = (1 << bits) - 1
    get = ranks.get
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    now = [get(text[i : i + 2]) for i in range(n - 1)]
    now.append(None)
    heap = [rank << bits | i for i, rank in enumerate(now) if rank is not None]
    heapify(heap)
    while heap:
        x = heappop(heap)
        i = x & low
        if now[i] != x >> bits:
            continue
        middle = end[i]
        end[i] = stop = end[middle]
        now[middle] = None
        if stop < n:
            before[stop] = i
            now[i] = rank = get(text[i : end[stop]])
            if rank is not None:
                heappush(heap, rank << bits | i)
        else:
            now[i] = None
        j = before[i]
        if j >= 0:
            now[j] = rank = get(text[j:stop])
            if rank is not None:
                heappush(heap, rank << bits | j)
    out, i = [], 0
    while i < n:
        out.append(ranks[text[i : end[i]]])
        i = end[i]
    return out


def _coder(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import regex

        vocab = vocabulary.value
        split = regex.compile(vocab.pattern).findall
        ids_of = Resolved(vocab.resolve).__getitem__
        words = vocab.by_id()

        def packed(docs, coded):
            ids = pa.Array.from_buffers(pa.int32(), sum(map(len, coded)) // 4, [None, pa.py_buffer(b"".join(coded))])
            ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            # The words of all ids, one after the other: a text ends where its last word does.
            told = words.take(ids)
            at = np.concatenate([[0], np.cumsum(pc.binary_length(told).to_numpy())])[ends].astype(np.int32)
            texts = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(at), told.buffers()[2] or pa.py_buffer(b"")])
            return pa.RecordBatch.from_arrays(
                [pa.array(docs, type=id_type), pa.ListArray.from_arrays(pa.array(ends), ids), texts], names=["_id", "ids", "decoded"]
            )

        for batch in batches:
            id_type = batch.column(0).type
            docs, coded, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                docs.append(doc)
                coded.append(b"".join(map(ids_of, split(text))))
                size += len(text)
                if size > BATCH_CHARS:
                    yield packed(docs, coded)
                    docs, coded, size = [], [], 0
            if docs:
                yield packed(docs, coded)

    return run


def encode_decode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, ids (array<int>) and decoded (binary, from the ids) of every whole text."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    vocabulary = spark.sparkContext.broadcast(Vocabulary(path, pattern))
    return (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .mapInArrow(_coder(vocabulary), f"_id {kind}, ids array<int>, decoded binary")
        .withColumnRenamed("_id", id_col)
    )


def decode(coded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and the bytes of an array of ids; null for a null array."""
    kind = coded.schema[id_col].dataType.simpleString()
    vocabulary = coded.sparkSession.sparkContext.broadcast(Vocabulary(path, pattern))

    def run(batches):
        word = vocabulary.value.by_id().to_pylist().__getitem__
        for batch in batches:
            texts = [None if x is None else b"".join(map(word, x)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.binary())], names=["_id", "decoded"])

    rows = coded.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    return rows.mapInArrow(run, f"_id {kind}, decoded binary").withColumnRenamed("_id", id_col)
