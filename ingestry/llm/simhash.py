"""Operator 1, SimHash near-dedup: vantage-point tree over fingerprints.

1. Every text's 64-bit fingerprint, in Arrow batches; equal fingerprints are one point.
2. A vantage-point tree, fitted on about ``SAMPLE`` points, splits the space into leaves:
   a point within a node's radius goes inside, others outside. By the triangle inequality a
   pair at most ``max_bits`` apart can only be separated where the outer point lies less
   than max_bits beyond the radius; those points also visit the inner side, and a visitor
   enters every side that its bounds don't rule out. So each close pair meets in one leaf
   (the sample decides how even the leaves are, never which pairs are found).
3. Each leaf compares its points with its points and visitors, exactly, in blocks; a leaf
   that holds more than ``BLOCK`` of either is split into pairs of blocks. A block hands on
   a spanning forest of its links, never the pairs themselves.
4. Components of the forest; a component's id is its smallest document id.

Edge cases: a null text counts as empty; a text without words has fingerprint zero and is
linked like any other; null ids keep their rows and take the component's smallest id;
repeated rows come back as often as they came; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import chosen, stage
from ingestry.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SAMPLE = 32_768  # points, about, that fit the tree; all that the driver gets
LEAF = 16_384  # points a leaf is meant to hold: fewer levels, so fewer visitors
BLOCK = 65_536  # points or visitors a task compares with as many
ROUTE_ROWS = 100_000
CELLS = 1 << 16  # comparisons in memory at once; they stay in the cache
HITS = 1 << 20  # links held before they are joined
SHINGLES_AT_ONCE = 100_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> bytes:
    """Eight bytes, the highest bit first: bits set in over half of the shingles' hashes."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # of bytes: A-Z, and runs without 09-0D and 20
    if not words:
        return bytes(8)
    digest = xxhash.xxh64_digest
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, n, SHINGLES_AT_ONCE):
        some = words[k : k + SHINGLES_AT_ONCE + shingle - 1]
        if shingle == 3 and len(some) >= 3:
            grams = [x + b" " + y + b" " + z for x, y, z in zip(some, some[1:], some[2:])]
        else:
            grams = [b" ".join(some[i : i + shingle]) for i in range(max(1, len(some) - shingle + 1))]
        hashes = np.frombuffer(b"".join([digest(g, SEED) for g in grams]), dtype=np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint ``fp`` as a long, row by row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            texts = (x.as_py() or b"" for x in batch.column(1))
            fps = np.frombuffer(b"".join(fingerprint(t, shingle) for t in texts), dtype=">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["_id", "fp"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, fp long").withColumnRenamed("_id", id_col)


def fit_tree(points, total: int, leaf: int = LEAF) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, radius, inner, outer) over a sample of ``total`` points; a child
    below zero is leaf -child - 1. No node: one leaf."""
    import numpy as np

    nodes: list = []
    leaves = [0]
    share = total / max(1, len(points))
    rng = np.random.default_rng(SEED)

    def grow(own) -> int:
        if len(own) * share > leaf and len(own) > 16:
            tries = own[rng.integers(0, len(own), 8)]
            gaps = np.bitwise_count(own[None, :] ^ tries[:, None]).astype(np.int64)
            best = gaps.std(axis=1).argmax()
            radius = int(np.median(gaps[best]))
            inside = gaps[best] <= radius
            if inside.all():  # ties at the median: draw the line below them
                radius = int(gaps[best].max()) - 1
                inside = gaps[best] <= radius
            if inside.any() and not inside.all():
                k = len(nodes)
                nodes.append(None)
                inner, outer = grow(own[inside]), grow(own[~inside])
                nodes[k] = (int(tries[best]), radius, inner, outer)
                return k
        leaves[0] += 1
        return -leaves[0]

    grow(points)
    return nodes


def route(nodes, points, reach: int) -> list[tuple[int, object, object]]:
    """(leaf, the points at home there, the visitors) for every leaf reached."""
    import numpy as np

    found = []
    work = [(0 if nodes else -1, points, points[:0])]
    while work:
        k, home, guests = work.pop()
        if not len(home) and not len(guests):
            continue
        if k < 0:
            found.append((-k - 1, home, guests))
            continue
        vantage, radius, inner, outer = nodes[k]
        d = np.bitwise_count(home ^ np.uint64(vantage)).astype(np.int64)
        g = np.bitwise_count(guests ^ np.uint64(vantage)).astype(np.int64)
        inside = d <= radius
        late = home[~inside & (d <= radius + reach)]
        work.append((inner, home[inside], np.concatenate([late, guests[g <= radius + reach]])))
        work.append((outer, home[~inside], guests[g > radius - reach]))
    return found


def _joined(parent, u, v):
    """Union-find over arrays: parent with u[i] and v[i] joined, every node at its root."""
    import numpy as np

    while True:
        ru, rv = parent[u], parent[v]
        apart = ru != rv
        if not apart.any():
            return parent
        u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
        np.minimum.at(parent, np.maximum(ru, rv), np.minimum(ru, rv))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def forest(home, others, reach: int):
    """Links of the graph {home} x {others}, at most reach bits apart, reduced to stars:
    arrays (point, root). A point equals only itself."""
    import numpy as np

    points = np.unique(np.concatenate([home, others]))
    parent = np.arange(len(points))
    at, asks = np.searchsorted(points, home), np.searchsorted(points, others)
    n = max(1, len(home))
    rows = max(1, CELLS // n)
    apart, bits = np.empty((rows, len(home)), dtype=np.uint64), np.empty((rows, len(home)), dtype=np.uint8)
    us, vs, held = [], [], 0
    for k in range(0, len(others), rows):
        some = others[k : k + rows]
        x = np.bitwise_xor(some[:, None], home[None, :], out=apart[: len(some)])
        c = np.bitwise_count(x, out=bits[: len(some)])
        np.subtract(c, 1, out=c)  # a point against itself becomes 255
        hit = np.flatnonzero((c < reach).ravel())
        if len(hit):
            us.append(asks[k + hit // n])
            vs.append(at[hit % n])
            held += len(hit)
        if held > HITS:
            parent = _joined(parent, np.concatenate(us), np.concatenate(vs))
            us, vs, held = [], [], 0
    if held:
        parent = _joined(parent, np.concatenate(us), np.concatenate(vs))
    moved = np.flatnonzero(parent != np.arange(len(points)))
    return points[moved], points[parent[moved]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """fps (fp long, distinct) -> edges (a, b) that connect just what pairs at most
    max_bits apart connect."""
    import numpy as np

    spark = fps.sparkSession
    total = fps.count()
    # About SAMPLE points, whatever the input's size.
    sample = [r["fp"] for r in chosen(fps, total, SAMPLE, "fp").collect()]
    points = np.array(sorted(sample), dtype=np.int64).view(np.uint64)
    nodes = fit_tree(points, total, leaf)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts):
            for k, home, guests in route(nodes, np.concatenate(parts), max_bits):
                n = len(home) + len(guests)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, k, dtype=np.int32)),
                        pa.array(np.arange(n) < len(home)),
                        pa.array(np.concatenate([home, guests]).view(np.int64)),
                    ],
                    names=["leaf", "home", "fp"],
                )

        parts, n = [], 0
        for batch in batches:
            parts.append(np.array(batch.column(0), dtype=np.int64).view(np.uint64))
            n += batch.num_rows
            if n >= ROUTE_ROWS:
                yield from out(parts)
                parts, n = [], 0
        if n:
            yield from out(parts)

    placed = stage(fps.select("fp").mapInArrow(routed, "leaf int, home boolean, fp long"), "leaves")
    # One row per leaf; the sample bounds their number.
    sizes = placed.groupBy("leaf").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / block).cast("int").alias("nh"),
        F.ceil(F.count("*") / block).cast("int").alias("nq"),
    )
    cut = sizes.filter("nh > 1 or nq > 1").collect()
    wide = spark.createDataFrame([tuple(r) for r in cut], "leaf int, nh int, nq int")
    rows = placed.join(F.broadcast(wide), "leaf", "left").select(
        "leaf", "home", "fp", F.coalesce("nh", F.lit(1)).alias("nh"), F.coalesce("nq", F.lit(1)).alias("nq")
    )
    rows = rows.filter("nh > 0")
    own = F.pmod(F.xxhash64("fp"), F.col("nh")).cast("int")
    ask = F.pmod(F.xxhash64("fp"), F.col("nq")).cast("int")
    homes = rows.filter("home").select(
        "leaf", own.alias("hb"), F.explode(F.expr("sequence(0, nq - 1)")).alias("qb"), F.lit(True).alias("home"), "fp"
    )
    asks = rows.select(
        "leaf", F.explode(F.expr("sequence(0, nh - 1)")).alias("hb"), ask.alias("qb"), F.lit(False).alias("home"), "fp"
    )

    def linked(table: pa.Table) -> pa.Table:
        fp = np.array(table.column("fp"), dtype=np.int64).view(np.uint64)
        home = np.array(table.column("home"), dtype=bool)
        a, b = forest(fp[home], fp[~home], max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return homes.union(asks).groupBy("leaf", "hb", "qb").applyInArrow(linked, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf: int = LEAF,
    block: int = BLOCK,
) -> DataFrame:
    """id, fp (long), fingerprint (16 hex digits) and component_id, row by row."""
    fps = stage(fingerprints(docs, shingle, id_col, text_col).withColumnRenamed(id_col, "_id"), "fingerprints")
    points = stage(fps.groupBy("fp").agg(F.min("_id").alias("least")), "points")
    roots = components(links(points, max_bits, leaf, block))
    # Points without links are components of their own.
    rooted = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        F.col("_id").alias(id_col),
        "fp",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
