"""Randomised checks of the set-based dedupe (W1/W2) and sequential merge
classification (W4) against a plain one-row-at-a-time fold, plus J1 cases."""

import datetime as dt
import random

from pyspark.sql import types as T

from ingestry import schema as S
from ingestry.operators import dedupe as D
from ingestry.operators import upsert as U


def fold_chunk(rows):
    """Reference semantics in plain Python: ties go to the later row."""
    best, losers = {}, {}
    for pos, key, ts in rows:
        cur = best.get(key)
        if cur is None:
            best[key] = (pos, ts)
        elif ts >= cur[1]:
            losers[cur[0]] = ts
            best[key] = (pos, ts)
        else:
            losers[pos] = cur[1]
    return {p for p, _ in best.values()}, losers


def test_dedupe_matches_fold(spark):
    rng = random.Random(7)
    base = dt.datetime(2026, 7, 30)
    rows = [(i + 1, f"k{rng.randrange(6)}", base + dt.timedelta(hours=rng.randrange(4))) for i in range(400)]
    df = spark.createDataFrame(
        [("f", (p - 1) // 50 + 1, p, k, ts) for p, k, ts in rows],
        f"{S.SOURCE_OBJECT} string, {S.CHUNK_INDEX} long, {S.ROW_ORDINAL} long, _c_student_id string, _ts timestamp",
    )
    marked = {r[S.ROW_ORDINAL]: r[D.KEPT_AT] for r in D.mark_chunk_duplicates(df).collect()}
    for c in range(1, 9):
        chunk = [r for r in rows if (r[0] - 1) // 50 + 1 == c]
        keep, lost = fold_chunk(chunk)
        for p, _, _ in chunk:
            assert (marked[p] is None) == (p in keep)
            if p in lost:
                assert marked[p] == lost[p]


def test_sequential_actions_match_fold(spark):
    rng = random.Random(11)
    base = dt.datetime(2026, 7, 30)
    target = [(f"k{i}", base + dt.timedelta(hours=rng.randrange(5))) for i in range(0, 8, 2)]
    surv = []
    for f in range(9):
        for c in range(1, 40):
            for k in rng.sample(range(8), 3):
                surv.append((f, c, f"k{k}", base + dt.timedelta(hours=rng.randrange(8))))
    stored = dict(target)
    expect = {}
    for f, c, k, ts in sorted(surv):
        prev = stored.get(k)
        expect[(f, c, k)] = "inserted" if prev is None else ("updated" if ts > prev else "skipped")
        if prev is None or ts > prev:
            stored[k] = ts
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("student_id", T.StringType()), ("updated_at", T.TimestampType())]])
    tdf = spark.createDataFrame(target, schema)
    sdf = spark.createDataFrame(surv, f"{S.FILE_ORDINAL} long, {S.CHUNK_INDEX} long, student_id string, updated_at timestamp")
    got = {(r[S.FILE_ORDINAL], r[S.CHUNK_INDEX], r.student_id): r.action
           for r in U.sequential_actions(tdf, sdf, block_chunks=8, block_files=2).collect()}
    assert got == expect


def _students(spark, rows):
    data = [(sid, "A", "B", None, "S", "a@b.edu", "active", ts, None, "csv", "{}", i) for i, (sid, ts) in enumerate(rows)]
    schema = T.StructType([f for f in S.STUDENT_SCHEMA.fields if f.name not in ("ingested_at", "last_written_at")]
                          + [T.StructField(S.ROW_ORDINAL, T.LongType())])
    return spark.createDataFrame(data, schema)


def test_conditional_upsert_cases(spark):
    from pyspark.sql import functions as F

    t0 = dt.datetime(2026, 7, 30, 8)
    as_of = F.expr("TIMESTAMP'2026-08-01 00:00:00'")
    empty = spark.createDataFrame([], S.STUDENT_SCHEMA)
    first = _students(spark, [("a", t0), ("b", t0), ("b", t0 + dt.timedelta(hours=1))])
    target, acts = U.conditional_upsert(empty, first, as_of=as_of)
    c = U.upsert_counts(acts).first()
    assert (c.submitted, c.inserted, c.updated, c.skipped) == (3, 2, 0, 1)
    target = spark.createDataFrame(target.collect(), S.STUDENT_SCHEMA)
    replay, acts2 = U.conditional_upsert(target, first, as_of=F.expr("TIMESTAMP'2026-08-02 00:00:00'"))
    assert sorted(map(tuple, replay.collect())) == sorted(map(tuple, target.collect()))
    assert {r.action for r in acts2.collect()} == {"skipped"}
    newer = _students(spark, [("a", t0 + dt.timedelta(hours=2)), ("b", t0 - dt.timedelta(hours=1)), ("c", t0)])
    _, acts3 = U.conditional_upsert(target, newer, as_of=as_of)
    assert {r.student_id: r.action for r in acts3.collect()} == {"a": "updated", "b": "skipped", "c": "inserted"}
    none, acts4 = U.conditional_upsert(target, newer.limit(0), as_of=as_of)
    assert U.upsert_counts(acts4).first().submitted == 0 and none.count() == 2
