"""Operator 12, embedding whitening: pivoted Cholesky, then one-sided Jacobi.

1. Vectors become vectors of longs, floor(256 c); every distinct one is in the fit list once
   (map-side combined, so a vector that a third of all rows share costs one row a task).
   The list is staged, as three passes read it.
2. Sums per dimension, exact; then the scatter of the vectors less their mean. Each task
   adds up its own rows and hands on one matrix, which Spark sums by cell.
3. The driver gets the scatter alone, dimension by dimension: pivoted Cholesky finds its
   rank and the triangular factor, and one-sided Jacobi rotates the factor's columns until
   they are orthogonal. Squared norms are the scatter's eigenvalues, the normalised columns
   its components.
4. Every row is projected where it lies.

Memory is bounded by the square of the dimension, in each task and on the driver, whatever
the number of rows.

Edge cases: rows whose vector is null, holds a null, NaN or infinite entry, or an entry
beyond a long after scaling, are dropped. An empty vector, like a shorter one beside longer
ones, has zeros in the dimensions that it lacks. Components of no variance (fewer distinct
vectors than components, or an empty table) are not returned, so their rows are missing.
A deviation beyond a long is null. Repeated rows and null ids come back as often as they
came; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import stage

COMPONENTS = 4
SCALE = 256
LONG = 1 << 63
PART = 1 << 20  # cells of a batch held as doubles at once


def _rows(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """_id and the vector of longs ``x`` of the rows that stay."""
    vector = F.col(vector_col).cast("array<double>")
    entries = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c))
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c * scale) < float(LONG), F.lit(False)))
    kept = df.filter(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(vector_col))
    # NaN compares as larger than any number, so it fails the same test as infinity
    return kept.select("_id", F.when(fits, entries).alias("x")).filter("x IS NOT NULL")


def _matrix(column: pa.Array, width: int):
    """The batch's vectors as one matrix of longs, shorter ones filled with zeros."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), dtype=np.int64)
    found[np.arange(width)[None, :] < sizes[:, None]] = flat
    return found


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, PART // max(1, width))
    for batch in batches:
        for k in range(0, batch.num_rows, step):
            yield batch.slice(k, step)


def _sums(fit: DataFrame, width: int) -> list[int]:
    """Exact sums per dimension: high and low halves apart, so that no task overflows."""

    def run(batches):
        import numpy as np

        high, low = [0] * width, [0] * width
        for part in _slices(batches, width):
            x = _matrix(part.column("x"), width)
            high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0, dtype=np.int64))]
            low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0, dtype=np.int64))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["i", "h", "l"]
        )

    parts = fit.mapInArrow(run, "i int, h long, l long").groupBy("i").agg(
        F.sum(F.col("h").cast("decimal(20,0)")).alias("h"), F.sum(F.col("l").cast("decimal(20,0)")).alias("l")
    )
    found = {r["i"]: (int(r["h"]) << 32) + int(r["l"]) for r in parts.collect()}
    return [found.get(i, 0) for i in range(width)]


@dataclass
class Centre:
    """The mean of a dimension is whole + rest, which keeps all digits of the rest."""

    n: int
    sums: list[int]

    def apart(self):
        import numpy as np

        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return np.array(whole, dtype=np.int64), np.array(rest)


def _less_mean(x, whole, rest):
    import numpy as np

    span = np.int64(LONG // 2 - 1)
    if len(x) and (np.abs(whole).max(initial=0) > span or x.max(initial=0) > span or x.min(initial=0) < -span):
        return (x.astype(np.longdouble) - whole - rest).astype(np.float64)
    return (x - whole) - rest


def _projected(v, directions):
    """v @ directions, summed entry by entry: equal vectors get equal bits whatever rows are beside
    them, which a matrix product leaves to its blocking."""
    import numpy as np

    out = np.zeros((len(v), directions.shape[1]))
    for j in range(directions.shape[0]):
        out += v[:, j, None] * directions[j]
    return out


def _scatter(fit: DataFrame, width: int, of) -> object:
    """Sum of v v' over the vectors v = of(x), as a matrix; each task hands on one."""
    import numpy as np

    def run(batches):
        size = None
        for part in batches:
            v = of(part.column("x"))
            size = v.T @ v if size is None else size + v.T @ v
        if size is not None:
            a, b = np.triu_indices(len(size))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(size[a, b])], names=["a", "b", "v"])

    def sliced(batches):
        return run(_slices(batches, width))

    cells = fit.mapInArrow(sliced, "a int, b int, v double").groupBy("a", "b").agg(F.sum("v").alias("v")).collect()
    side = max((r["b"] for r in cells), default=-1) + 1
    found = np.zeros((side, side))
    for r in cells:
        found[r["a"], r["b"]] = found[r["b"], r["a"]] = r["v"]
    return found


def pivoted_cholesky(a):
    """L with L L' = a up to rounding: row order as in a, one column per unit of rank, every
    column led by the largest diagonal entry left."""
    import numpy as np

    left = a.diagonal().copy()
    factor = np.zeros_like(a)
    floor = len(a) * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    rank = 0
    for rank in range(len(a) + 1):
        if rank == len(a):
            break
        p = int(left.argmax())
        if left[p] <= floor:
            break
        column = (a[:, p] - factor[:, :rank] @ factor[p, :rank]) / np.sqrt(left[p])
        column[left <= -1] = 0.0  # rows already led
        factor[:, rank] = column
        left = np.where(left <= -1, left, np.maximum(left - column**2, 0.0))
        left[p] = -1.0
    return factor[:, :rank]


def one_sided_jacobi(factor):
    """(norms, unit columns) of the factor with its columns rotated to be orthogonal, by
    falling norm. A round turns disjoint pairs of columns at once; all pairs make a sweep."""
    import numpy as np

    g = factor.copy()
    k = g.shape[1]
    ring = list(range(k + k % 2))
    for _ in range(60):
        turned = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(p, q) for p, q in zip(ring[:half], ring[::-1][:half]) if p < k and q < k]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = np.array(pairs, dtype=int).reshape(-1, 2).T
            gp, gq = g[:, p], g[:, q]
            alpha, beta, gamma = (gp**2).sum(axis=0), (gq**2).sum(axis=0), (gp * gq).sum(axis=0)
            share = np.abs(gamma) / np.maximum(np.sqrt(alpha) * np.sqrt(beta), np.finfo(float).tiny)
            turned = max(turned, share.max(initial=0.0))
            safe = np.where(gamma == 0, 1.0, gamma)
            zeta = (beta - alpha) / (2 * safe)
            t = np.where(gamma == 0, 0.0, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)))
            c = 1 / np.sqrt(1 + t**2)
            s = c * t
            g[:, p], g[:, q] = c * gp - s * gq, s * gp + c * gq
        if turned < 1e-15:
            break
    norms = np.sqrt((g**2).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    return norms[order], g[:, order] / norms[order]


@dataclass
class Whitener:
    """A fitted whitening: ``apply`` projects the vectors of any rows."""

    centre: Centre
    width: int
    eigenvalues: list[float]
    explained: list[float]
    directions: object  # one column per component
    identity_error: float


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitener | None:
    """None if there is no vector, or none that differs from another."""
    import numpy as np

    listed = stage(_rows(df.withColumn("_none", F.lit(None).cast("long")), "_none", vector_col, scale).select("x").distinct(), "whitening")
    size = listed.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d"), F.min(F.size("x")).alias("least")).first()
    width = size["d"] or 0
    if not width:
        return None
    n = size["n"]
    if size["least"] < width:  # of different lengths: zeros fill up
        padded = F.expr(f"concat(x, array_repeat(0L, {width} - size(x)))")
        listed = stage(listed.select(padded.alias("x")).distinct(), "whitening")
        n = listed.count()
    centre = Centre(n, _sums(listed, width))
    whole, rest = centre.apart()
    scatter = _scatter(listed, width, lambda x: _less_mean(_matrix(x, width), whole, rest))
    norms, columns = one_sided_jacobi(pivoted_cholesky(scatter))
    k = min(components, len(norms))
    if not k:
        return None
    values = norms**2 / n
    directions = columns[:, :k]
    roots = norms[:k] / np.sqrt(n)

    def white(x):
        return _projected(_less_mean(_matrix(x, width), whole, rest), directions) / roots

    # the mean of what was whitened, to centre it before multiplying
    with_one = _scatter(listed, width, lambda x: np.column_stack([np.ones(len(x)), white(x)]))
    mean = with_one[0, 1:] / n
    covariance = _scatter(listed, width, lambda x: white(x) - mean) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    total = float(scatter.trace()) / n
    return Whitener(centre, width, values[:k].tolist(), (values[:k] / total).tolist(), directions, error)


def apply(df: DataFrame, fitted: Whitener | None, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """One row per kept row of df and component."""
    kind = df.schema[id_col].dataType.simpleString()
    out = f"_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches):
        import numpy as np

        whole, rest = fitted.centre.apart()
        n, sums, width = fitted.centre.n, fitted.centre.sums, fitted.width
        k = len(fitted.eigenvalues)
        roots = np.sqrt(np.array(fitted.eigenvalues))
        furthest = max(abs(s) for s in sums)
        for part in _slices(batches, width):
            x = _matrix(part.column("x"), width)
            white = _projected(_less_mean(x, whole, rest), fitted.directions) / roots
            reach = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + furthest
            if reach * reach * width < LONG:
                far = ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
            else:  # exact at any size
                far = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
                far = [v if v < LONG else None for v in far]
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, dtype=np.int64)),
                    pa.array([v for v in far for _ in range(k)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(fitted.explained, m)),
                    pa.array(np.full(m * k, fitted.identity_error)),
                ],
                names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    rows = _rows(df, id_col, vector_col, scale)
    if fitted is None:
        return df.sparkSession.createDataFrame([], out).withColumnRenamed("_id", id_col)
    return rows.mapInArrow(run, out).withColumnRenamed("_id", id_col)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Fit on the distinct vectors of df and apply to all of its rows."""
    return apply(df, fit(df, vector_col, components, scale), id_col, vector_col, scale)
