"""Operator 13 against plain Python over the same term hashes."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from llm_fixtures import corpus, frame, odd
from pyspark.sql import functions as F

from ingestry.llm import fingerprints
from ingestry.llm.queries import QUERIES


def chained(*parts):
    h = 42
    for x in parts:
        if x is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<i", x) if isinstance(x, int) else x.encode(), seed=h)
    return h


def brute_print(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    terms = list(zip(ws, ws[1:])) if len(ws) > 1 else [(w, None) for w in ws]
    found = 0
    for i in range(2):
        count, total = [0] * 64, 0
        for a, b in terms:
            w = min(16, len(a) + len(b or ""))
            total += w
            h = chained(i, a, b)
            for k in range(64):
                count[k] += w * (h >> k & 1)
        found |= sum(1 << k for k in range(64) if 2 * count[k] > total) << (64 * (1 - i))
    return found


def brute(rows, radius=fingerprints.RADIUS):
    """By doc_id (each there once): the row that the operator returns for it."""
    order = sorted(((k, t or "") for k, t in rows), reverse=True)
    prints = [brute_print(t) for _, t in order]
    distinct = set(prints)
    found = {}
    for i, (k, t) in enumerate(order):
        j = (i + 1) % len(order)
        cut = len(t) // 3
        new = t[: len(t) - cut] + order[j][1][:cut]
        e = brute_print(new)
        found[k] = (
            k,
            len(t),
            hashlib.sha256(new.encode()).hexdigest(),
            f"{prints[i]:032x}",
            f"{e:032x}",
            1 - (prints[i] ^ e).bit_count() / 128,
            1 - (prints[i] ^ prints[j]).bit_count() / 128,
            min(d for (d, _), p in zip(order, prints) if p == prints[i]),
            sum(1 <= (prints[i] ^ p).bit_count() <= radius for p in distinct),
        )
    return found


def test_against_python(spark):
    rows = corpus()
    want = brute(rows)
    got = [tuple(r) for r in fingerprints.fingerprint(frame(spark, rows).repartition(7)).collect()]
    assert sorted(got) == sorted(want.values())
    one = {r[0]: r for r in got}
    assert one[0][3] == one[24][3] == one[25][3] and one[24][7] == 0  # copies


def test_rows_that_repeat(spark):
    rows = [(k, t) for k, t in corpus()[:20]]
    want = sorted(brute(rows).values())
    got = fingerprints.fingerprint(frame(spark, rows + rows[3:5] + [rows[4]] * 300).repartition(5)).collect()
    assert sorted({tuple(r) for r in got}) == want
    assert sum(r["doc_id"] == 4 for r in got) == 302 and len(got) == 322


def test_odd_rows(spark):
    got = fingerprints.fingerprint(odd(spark)).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"]) for r in got) == [
        (False, 0, 0), (False, 0, 23), (True, 3, 18), (True, 3, 18), (True, 4, 0), (True, 5, 0),
    ]
    empty = fingerprints.fingerprint(frame(spark, []))
    assert empty.collect() == []
    assert empty.columns[:7] == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    alone = fingerprints.fingerprint(frame(spark, [(9, "abcdef")])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and alone["near_next"] == 1.0


@pytest.mark.parametrize("radius, blocks, bucket", [(3, 6, 4096), (6, 8, 5), (2, 3, 10), (0, 2, 3)])
def test_near(spark, radius, blocks, bucket):
    """All links, of points at random, of a dense group in one bucket, and at block borders."""
    rng = random.Random(radius)
    points = {rng.getrandbits(128) for _ in range(150)}
    for p in list(points)[:40]:
        points.add(p ^ sum(1 << b for b in rng.sample(range(128), rng.randint(1, radius + 2))))
    dense = rng.getrandbits(128)
    points |= {dense ^ (1 << b) for b in range(100, 128)} | {dense, dense ^ (3 << 63), dense ^ (1 << 127)}
    word = (1 << 64) - 1
    rows = [([fingerprints.signed(p >> (64 * i) & word) for i in range(2)],) for p in points]
    got = fingerprints.near(spark.createDataFrame(rows, "fp array<long>"), radius, blocks, bucket)
    got = [tuple(tuple(x) for x in r) for r in got.collect()]
    mine = [tuple(r[0]) for r in rows]
    want = {(a, b) for a in mine for b in mine if a != b and sum(((x ^ y) & word).bit_count() for x, y in zip(a, b)) <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_texts_move_once(spark):
    """One exchange of whole texts, used by both joins; no Python."""
    _, texts = fingerprints.edited(frame(spark, corpus(), clash=False))
    fingerprints.votes(texts, ["k1", "k2"], "edited").collect()
    plan = fingerprints.votes(texts, ["k1", "k2"], "edited")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    with pytest.raises(ValueError):
        fingerprints.masks(3, 3)


def test_registered(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_document_fingerprints"](spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows).values())
    assert got.select(F.max("near_edited")).first()[0] <= 1
