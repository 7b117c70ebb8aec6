"""Operator 2, suffix-array dedup: longest-previous-factor arrays, over shards by anchor.

Suffixes of all texts can't be sorted in one place, so they are split by content first. A
string of ``length`` bytes has an anchor, its 32-byte gram of the smallest hash (the first
of equals); equal strings have equal anchors at the same offset. All strings of one anchor
place are a context, a stretch of text of at most 2 x length bytes.

1. Every document's contexts, by 128-bit hash, with their places; narrow rows, staged.
2. An anchor that occurs once has no repeat, and its rows are dropped before any shuffle but
   that of the count. If all contexts of an anchor are equal, every string in them repeats.
   Neither needs any text.
3. Of the anchors with different contexts, one text of each different context is fetched
   and the contexts of an anchor meet in one task, in order of place. There a suffix array
   (prefix doubling) and the common prefixes of its neighbours give, by the previous and next
   smaller positions in suffix order, every position's longest previous factor (LPF): a string
   repeats earlier if LPF >= length. Larger positions give the longest next factor likewise.
   An anchor with more than ``max_contexts`` different contexts is compared string by string,
   by 128-bit hashes, which spreads over all tasks.
4. The strings found give the byte spans to remove, which join the texts again.

Whole texts are shuffled only where a sieve of fixed size (`common.sieve`) says that the
document may be wanted: for a fetch in step 3, for a cut in step 4. All others pass through.

``keep="first"`` removes all but the first copy (by id, text hash, position); ``keep="none"``
removes every byte of a repeated string. Strings are judged on the input.

Edge cases: a null text counts as empty; texts shorter than length bytes lose nothing; rows
with equal id and text are separate copies under keep="none" and one document under
keep="first"; null ids sort first; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import sieve, sifted, stage

LENGTH = 400
GRAM = 32
MAX_CONTEXTS = 6_000  # of one anchor under one suffix array: at most 5 MB of text
PIECE = 1 << 22  # bytes of a text whose anchors are found at once
SORT_BYTES = 1 << 20  # bytes of contexts under one suffix array (a whole anchor at least)
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def gram_hashes(text: bytes, gram: int):
    """A 64-bit hash of every gram of the text (gram: a multiple of 8, at most 32)."""
    import numpy as np

    words = np.ndarray(len(text) - 7, dtype="<u8", buffer=text, strides=(1,)).astype(np.uint64)
    n = len(text) - gram + 1
    h = np.zeros(n, dtype=np.uint64)
    for k in range(gram // 8):
        h = (h ^ words[8 * k : 8 * k + n]) * np.uint64(MULTIPLIERS[k])
        h ^= h >> np.uint64(31)
    return h


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM):
    """(starts, stops, places): strings starting at starts[i] .. stops[i] - 1 have their
    anchor at places[i]."""
    import numpy as np

    found = []
    window = length - gram + 1
    for at in range(0, max(0, len(text) - length + 1), PIECE):
        piece = text[at : at + PIECE + length - 1]
        h = gram_hashes(piece, gram)
        n = len(h)
        # hash above, position below: the smallest is the first of the smallest hashes
        keys = (h & ~np.uint64(0x7FFFFF)) | np.arange(n, dtype=np.uint64)
        padded = np.full(-(-n // window) * window, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:n] = keys
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: n - window + 1], ahead[window - 1 : n])
        found.append((least & np.uint64(0x7FFFFF)).astype(np.int64) + at)
    if not found:
        return np.zeros((3, 0), dtype=np.int64)
    places = np.concatenate(found)
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    return np.stack([starts, np.append(starts[1:], len(places)), places[starts]])


def _contexts(length: int, gram: int, id_type):
    """Batches (_id, _text) to rows (id, th, g, c1, c2, at, n): an anchor's hash g, its
    context's hash, the places of equal contexts in the document and their strings n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct

        import numpy as np
        import xxhash

        digest = xxhash.xxh3_128_digest
        read = struct.Struct("<qq").unpack
        for batch in batches:
            rows = []
            for doc, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py() or b""
                own: dict[tuple, list[int]] = {}
                for start, stop, place in anchors(text, length, gram).T.tolist():
                    g = xxhash.xxh64_intdigest(text[place : place + gram]) - (1 << 63)
                    c = digest(text[start : stop + length - 1] + (place - start).to_bytes(4, "little"))
                    own.setdefault((g, c, stop - start), []).append(start)
                rows += [(doc, th, g, *read(c), at, n) for (g, c, n), at in own.items()]
                if len(rows) > 100_000:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)

    kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32()]
    names = ["id", "th", "g", "c1", "c2", "at", "n"]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def suffix_ranks(text: bytes, left, length: int):
    """[(size, ranks)]: the rank of the string of `size` bytes at every position that has so many
    left (left: the bytes to the end of the position's context), by prefix doubling up to
    length; equal ranks are equal strings."""
    import numpy as np

    def ranked(at, keys):
        order = np.argsort(keys)
        keys = keys[order]
        rank = np.zeros(len(text), dtype=np.int32)
        rank[at[order]] = np.cumsum(np.concatenate([[False], keys[1:] != keys[:-1]]), dtype=np.int32)
        return rank

    at = np.flatnonzero(left >= 8).astype(np.int32)
    levels = [(8, ranked(at, np.ndarray(len(text) - 7, dtype=">u8", buffer=text, strides=(1,))[at].astype(np.uint64)))]
    while levels[-1][0] < length:
        size, rank = levels[-1]
        step = min(size, length - size)
        at = np.flatnonzero(left >= size + step).astype(np.int32)
        levels.append((size + step, ranked(at, rank[at].astype(np.int64) * len(rank) + rank[at + step])))
    return levels


def neighbour_prefixes(text: bytes, order, levels, length: int):
    """Bytes that each suffix of `order` shares with the one before it, at most length."""
    import numpy as np

    a, b = order[:-1], order[1:]
    whole = levels[-1][1]
    shared = np.where(whole[a] == whole[b], length, 0)
    rest = np.flatnonzero(shared == 0)
    a, b = a[rest], b[rest]
    off = np.zeros(len(rest), dtype=np.int64)
    for size, rank in reversed(levels[:-1]):
        # beyond length there is nothing shared here, nor a rank to look at
        fits = off + size <= length
        at = np.where(fits, off, 0)
        off += np.where(fits & (rank[a + at] == rank[b + at]), size, 0)
    raw = np.frombuffer(text, dtype=np.uint8)
    same = np.ones(len(rest), dtype=bool)
    for _ in range(7):
        same &= raw[a + off] == raw[b + off]
        off += same
    shared[rest] = off
    return shared


def longest_factors(order, shared, *, previous: bool = True):
    """For each suffix of `order` the longest prefix that it shares with one that begins earlier
    (or later, without `previous`): the larger of those shared with its nearest neighbours in
    suffix order that do. All pointers jump at once, over neighbours that have jumped before."""
    import numpy as np

    n = len(order)
    key = order.astype(np.int64) if previous else -order.astype(np.int64)
    best = np.zeros(n, dtype=np.int64)
    for turn in (1, -1):
        k, lcp = key[::turn], shared[::turn]
        keyed = np.concatenate([[np.iinfo(np.int64).min], k])  # nothing beyond the end is smaller
        to = np.arange(n + 1) - 1
        to[0] = 0
        least = np.concatenate([[0, 0], lcp]).astype(np.int64)  # shared with all on the way to `to`
        work = np.arange(1, n + 1)
        while len(work := work[keyed[to[work]] > keyed[work]]):
            via = to[work]
            least[work] = np.minimum(least[work], least[via])
            to[work] = to[via]
        found = np.where(to[1:] == 0, 0, least[1:])
        best = np.maximum(best, found[::turn])
    return best


def repeats(contexts: list[bytes], length: int, keep: str) -> list[list[tuple[int, int]]]:
    """Contexts in order of place. For each the spans [low, high) of starts whose string
    occurs earlier (keep="first") or anywhere else (keep="none") among them."""
    import numpy as np

    text = b"".join(contexts)
    sizes = np.array([len(c) for c in contexts])
    edges = np.concatenate([[0], np.cumsum(sizes)])
    left = np.repeat(edges[1:].astype(np.int32), sizes) - np.arange(len(text), dtype=np.int32)
    levels = suffix_ranks(text, left, length)
    starts = np.flatnonzero(left >= length).astype(np.int32)
    order = starts[np.argsort(levels[-1][1][starts], kind="stable")]  # the suffix array, ties by place
    shared = neighbour_prefixes(text, order, levels, length)
    hit = np.zeros(len(text), dtype=bool)
    hit[order[longest_factors(order, shared) >= length]] = True
    if keep == "none":
        hit[order[longest_factors(order, shared, previous=False) >= length]] = True
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = np.concatenate([[False], hit[a : b - length + 1], [False]])
        turns = np.flatnonzero(own[1:] != own[:-1])
        out.append(list(zip(turns[::2].tolist(), turns[1::2].tolist())))
    return out


_RUNS = "array<struct<low:int,high:int>>"


def _by_suffix_array(length: int, keep: str):
    """Batches (g, c1, c2, bytes), sorted by g and place, to (g, c1, c2, runs). A context of
    which several equal rows sent the text comes more than once, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows):
            found = repeats([r[3] for r in rows], length, keep)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))]
            cols = [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [[{"low": a, "high": b} for a, b in x] for x in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=["g", "c1", "c2", "runs"])

        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if rows and rows[-1][:3] == row[:3]:
                    continue
                if size > SORT_BYTES and rows[-1][0] != row[0]:
                    yield packed(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield packed(rows)

    return run


def _strings(length: int):
    """Batches (g, c1, c2, bytes) to a row (g, c1, c2, s, w1, w2) per string in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct

        import xxhash

        digest, read = xxhash.xxh3_128_digest, struct.Struct("<qq").unpack
        for batch in batches:
            for g, c1, c2, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                n = len(text) - length + 1
                pairs = [read(digest(text[s : s + length])) for s in range(n)]
                cols = [[g] * n, [c1] * n, [c2] * n, range(n), [a for a, _ in pairs], [b for _, b in pairs]]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in cols], names=["g", "c1", "c2", "s", "w1", "w2"])

    return run


def _by_hash(texts: DataFrame, length: int, keep: str) -> DataFrame:
    """(g, c1, c2, place, bytes) of anchors with very many contexts -> (g, c1, c2, runs)."""
    strings = texts.select("g", "c1", "c2", "bytes").mapInArrow(_strings(length), "g long, c1 long, c2 long, s long, w1 long, w2 long")
    placed = strings.join(texts.select("g", "c1", "c2", "place"), ["g", "c1", "c2"])
    # Pre-aggregated: a string that many contexts share is one row per task.
    known = placed.groupBy("w1", "w2").agg(F.count("*").alias("c"), F.min("place").alias("least")).filter("c > 1")
    hit = placed.join(known, ["w1", "w2"])
    if keep == "first":
        hit = hit.filter(~F.col("place").eqNullSafe(F.col("least")))
    # The strings of one context, at most length of them.
    return hit.groupBy("g", "c1", "c2").agg(
        F.sort_array(F.collect_list(F.struct(F.col("s").cast("int").alias("low"), (F.col("s") + 1).cast("int").alias("high")))).alias("runs")
    )


def _slices(id_type):
    """Batches (id, th, text, wanted array of (g, c1, c2, start, stop)) to a row (g, c1, c2, id,
    th, at, bytes) for each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), id_type, pa.int64(), pa.int32(), pa.binary()]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=SLICE)

        for batch in batches:
            rows, size = [], 0
            for doc, th, text, wanted in zip(*(batch.column(k) for k in range(4))):
                doc, th, text = doc.as_py(), th.as_py(), text.as_py()
                for w in wanted.as_py():
                    rows.append((w["g"], w["c1"], w["c2"], doc, th, w["start"], text[w["start"] : w["stop"]]))
                    size += w["stop"] - w["start"]
                    if size > SORT_BYTES:
                        yield packed(rows)
                        rows, size = [], 0
            if rows:
                yield packed(rows)

    return run


SLICE = ["g", "c1", "c2", "id", "th", "at", "bytes"]


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, keep: str = "first", max_contexts: int = MAX_CONTEXTS, gram: int = GRAM
) -> DataFrame:
    """docs (_id, th, _text binary) -> (id, th, spans): the byte spans to remove of every
    document that has any, unmerged, as array<struct<a, b>>."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["_id"].dataType
    schema = f"id {kind.simpleString()}, th long, g long, c1 long, c2 long, at array<int>, n int"
    places = stage(docs.mapInArrow(_contexts(length, gram, to_arrow_type(kind)), schema), "contexts")
    # Anchors that stand somewhere twice; what passes their sieve is all that moves on.
    twice = places.groupBy("g").agg(F.sum(F.size("at")).alias("all")).filter("all > 1").select("g")
    twice = stage(twice, "anchors")
    places = stage(sifted(places, sieve(twice, "g"), "g")[0].join(twice, "g", "left_semi"), "repeated")
    # One row per different context, with its first place.
    different = places.groupBy("g", "c1", "c2").agg(
        F.sum(F.size("at")).alias("copies"), F.min("n").alias("n"), F.min(F.struct("id", "th", F.col("at")[0].alias("at"))).alias("place")
    )
    different = stage(different, "different")
    met = different.groupBy("g").agg(F.min("copies").alias("fewest"), F.count("*").alias("kinds"))
    judged = stage(different.join(met, "g"), "judged")
    mixed = judged.filter("kinds > 1")
    if keep == "none":
        mixed = mixed.filter("fewest = 1")  # of the others every string repeats anyway

    def fetched(contexts: DataFrame) -> DataFrame:
        """The texts of contexts, from the documents of their first places."""
        wanted = contexts.select(
            F.col("place.id").alias("id"),
            F.col("place.th").alias("th"),
            F.struct("g", "c1", "c2", F.col("place.at").alias("start"), (F.col("place.at") + F.col("n") + length - 1).alias("stop")).alias("w"),
        )
        wanted = wanted.groupBy("id", "th").agg(F.collect_list("w").alias("wanted"))
        own = sifted(docs, sieve(contexts.select("place.th"), "th"), "th")[0]
        # Rows of equal id and text are alike, and send the same.
        texts = own.join(wanted, own["_id"].eqNullSafe(wanted["id"]) & (own["th"] == wanted["th"]))
        texts = texts.select("id", own["th"], "_text", "wanted")
        slices = f"g long, c1 long, c2 long, id {kind.simpleString()}, th long, at int, bytes binary"
        return texts.mapInArrow(_slices(to_arrow_type(kind)), slices)

    few = fetched(mixed.filter(F.col("kinds") <= max_contexts)).repartition("g").sortWithinPartitions("g", "id", "th", "at")
    runs = few.select("g", "c1", "c2", "bytes").mapInArrow(_by_suffix_array(length, keep), f"g long, c1 long, c2 long, runs {_RUNS}")
    large = mixed.filter(F.col("kinds") > max_contexts)
    if large.limit(1).count():
        many = stage(fetched(large), "slices").dropDuplicates(["g", "c1", "c2"])
        runs = runs.union(_by_hash(many.withColumn("place", F.struct("id", "th", "at")), length, keep))
    whole = F.array(F.struct(F.lit(0).alias("low"), F.col("n").alias("high")))
    none = F.expr(f"cast(array() as {_RUNS})")
    judged = judged.join(runs, ["g", "c1", "c2"], "left").select("g", "c1", "c2", "place", "copies", F.coalesce("runs", none).alias("runs"))
    found = places.join(judged, ["g", "c1", "c2"])
    first = F.col("place").eqNullSafe(F.struct("id", "th", F.col("at")[0].alias("at")))
    if keep == "first":
        # the first place has its own runs; every other one repeats it
        more = F.transform("at", lambda p, i: F.struct(p.alias("p"), F.when(first & (i == 0), F.col("runs")).otherwise(whole).alias("runs")))
    else:
        own = F.when(F.col("copies") > 1, whole).otherwise(F.col("runs"))
        more = F.transform("at", lambda p: F.struct(p.alias("p"), own.alias("runs")))
    spans = F.flatten(
        F.transform(
            more,
            lambda m: F.transform(
                m["runs"], lambda r: F.struct((m["p"] + r["low"]).alias("a"), (m["p"] + r["high"] + length - 1).alias("b"))
            ),
        )
    )
    found = found.select("id", "th", spans.alias("spans")).filter(F.size("spans") > 0)
    return found.groupBy("id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut(id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                text, merged = text.as_py() or b"", []
                for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                at, out = 0, []
                for a, b in merged:
                    out.append(text[at:a])
                    at = b
                out.append(text[at:])
                kept.append(b"".join(out))
                removed.append([{"a": a, "b": b} for a, b in merged])
            spans_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).fill_null(b""), pa.array(kept, type=pa.binary()), pa.array(removed, type=spans_type)],
                names=["_id", "bytes", "kept", "removed"],
            )

    return run


def dedup(
    docs: DataFrame,
    length: int = LENGTH,
    keep: str = "first",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_contexts: int = MAX_CONTEXTS,
    gram: int = GRAM,
) -> DataFrame:
    """id, n_bytes, kept (binary: the bytes that stay) and removed (merged byte spans)."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("binary").alias("_text"))
    spans = repeated_spans(rows, length, keep, max_contexts, gram)
    spans = stage(spans, "spans")
    some, rest = sifted(rows, sieve(spans, "th"), "th")
    joined = some.join(spans, some["_id"].eqNullSafe(spans["id"]) & (some["th"] == spans["th"]), "left").select("_id", "_text", "spans")
    joined = joined.unionByName(rest.select("_id", "_text"), allowMissingColumns=True)
    schema = f"_id {kind.simpleString()}, bytes binary, kept binary, removed array<struct<a:int,b:int>>"
    out = joined.mapInArrow(_cut(to_arrow_type(kind)), schema)
    return out.select(F.col("_id").alias(id_col), F.octet_length("bytes").cast("long").alias("n_bytes"), "kept", "removed")
