"""Operator 12 against numpy's eigenvalues over the same fit list."""

import math
import random

import numpy as np
import pytest

from ingestry.llm import whitening
from ingestry.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x int, _id int, component int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0, 7, 7, 7) for k, v in rows], SCHEMA).repartition(5)


def longs(v):
    return None if v is None or any(c is None or not math.isfinite(c) for c in v) else [math.floor(256 * float(np.float32(c))) for c in v]


def brute(rows):
    """{vec_id: [(component, n, deviation, |whitened|, explained)]}, repeated rows once."""
    kept = [(k, longs(v)) for k, v in rows]
    kept = [(k, v) for k, v in kept if v is not None]
    width = max(map(len, (v for _, v in kept)))
    kept = [(k, v + [0] * (width - len(v))) for k, v in kept]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    whole = [s // n for s in sums]
    a = np.array([[x - w for x, w in zip(v, whole)] for v in fit], dtype=float) - np.array([(s - w * n) / n for s, w in zip(sums, whole)])
    values, vectors = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)[:4]
    found = {}
    for k, v in kept:
        y = np.array([x - w for x, w in zip(v, whole)], dtype=float) - np.array([(s - w * n) / n for s, w in zip(sums, whole)])
        far = sum((n * x - s) ** 2 for x, s in zip(v, sums))
        found[k] = [
            (c + 1, n, far, abs(y @ vectors[:, j] / math.sqrt(values[j])), values[j] / values.sum())
            for c, j in enumerate(order)
            if values[j] > 1e-9 * values.max()
        ]
    return found


def same(rows, got):
    want = brute(rows)
    seen = {}
    for r in got:
        seen.setdefault(r["vec_id"], []).append(r)
        assert r["identity_error"] <= 1e-8
    assert set(seen) == set(want)
    for k, parts in want.items():
        for c, n, far, white, share in parts:
            mine = [r for r in seen[k] if r["component"] == c]
            assert mine and all(r["n"] == n and r["deviation"] == far for r in mine)
            assert all(abs(abs(r["whitened"]) - white) < 1e-6 * max(1, white) for r in mine)
            assert all(abs(r["explained"] / share - 1) < 1e-6 for r in mine)
        assert len({r["component"] for r in seen[k]}) == len(parts)


def made(seed, n, width, shift=0.0):
    rng = random.Random(seed)
    return [(k, [shift + rng.gauss(0, 1 / (j + 1)) for j in range(width)]) for k in range(n)]


@pytest.mark.parametrize("shift", [0.0, 3000.0])
def test_against_eigenvalues(spark, shift):
    rows = made(1, 300, 12, shift)
    hot = [(1000 + k, rows[0][1]) for k in range(150)]  # a third of all rows share one vector
    odd = [(2000, None), (2001, [None] * 12), (2002, [math.nan] + [0.0] * 11), (2003, [math.inf] + [0.0] * 11), (2004, [-0.0] * 12)]
    got = whitening.whiten(frame(spark, rows + hot + odd + [rows[5]])).collect()
    same(rows + hot + odd, got)
    assert sum(r["vec_id"] == 5 for r in got) == 8
    apart = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    assert all(apart[0, c] == apart[1000 + k, c] for k in range(150) for c in range(1, 5))


def test_lengths_rank_and_empty(spark):
    rows = made(2, 40, 5)
    same(rows + [(90, [1.0, 2.0]), (91, [])], whitening.whiten(frame(spark, rows + [(90, [1.0, 2.0]), (91, [])])).collect())
    line = [(k, [float(k), 2.0 * k, -float(k)]) for k in range(6)]  # rank one
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 6
    same(line, got)
    for rows in ([], [(1, [1.0, 2.0])], [(1, None)], [(1, []), (2, [])]):
        out = whitening.whiten(frame(spark, rows))
        assert out.collect() == []
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [3e15, 1.0]), (3, [-3e15, 2.0]), (4, [0.0, 3.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in got} == {2, 3, 4}  # 256e30 is no long
    assert all(r["deviation"] is None for r in got if r["vec_id"] != 4)
    none = frame(spark, [(None, [1.0, 0.5]), (None, [2.0, 9.5])])
    assert [r["vec_id"] for r in whitening.whiten(none).collect()] == [None, None]


def test_registered(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall()
    same([(k, list(v)) for k, v in rows], QUERIES["op12_embedding_whitening"](spark, sf).collect())


def test_factors():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(30, 9))
    a = np.column_stack([a, a[:, 0] + a[:, 1], np.zeros(30)])
    s = a.T @ a
    factor = whitening.pivoted_cholesky(s)
    assert factor.shape[1] == 9 and np.abs(factor @ factor.T - s).max() < 1e-12 * np.abs(s).max()
    norms, columns = whitening.one_sided_jacobi(factor)
    assert np.abs(norms**2 - np.sort(np.linalg.eigvalsh(s))[::-1][:9]).max() < 1e-12 * norms[0] ** 2
    assert np.abs(columns.T @ columns - np.eye(9)).max() < 1e-13
