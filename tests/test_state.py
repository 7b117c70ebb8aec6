"""The versioned state: overlapping jobs, buckets, claims, compaction, upkeep."""

import os
import time

import fixtures as FX
import pytest
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.plans import jobs
from ingestry.plans import state as ST
from ingestry.plans.jobs import StateStore, run_api_job, run_csv_job


def rows(spark, records, file=0, chunk=1):
    """Canonical rows as `Batch.students` has them."""
    kinds = {f.name: f.dataType for f in S.STUDENT_SCHEMA.fields}
    made = [
        {c: None for c in kinds} | {k: v for k, v in FX.record(n, **changes).items() if k in kinds} for n, changes in records
    ]
    df = spark.createDataFrame([tuple(str(r[c]) if r[c] is not None else None for c in kinds) for r in made],
                               ", ".join(f"{c} string" for c in kinds))
    return df.select(
        *[F.col(c).cast(t).alias(c) for c, t in kinds.items()],
        F.lit("f").alias(S.SOURCE_OBJECT), F.lit(file).cast("long").alias(S.FILE_ORDINAL), F.lit(chunk).cast("long").alias(S.CHUNK_INDEX),
    )


def merge(spark, store, head, records, tmp_path):
    stage = str(tmp_path / f"stage-{time.time_ns()}")
    return store.merge(head, rows(spark, records), stage, as_of_sql=FX.AS_OF, seq=(S.FILE_ORDINAL, S.CHUNK_INDEX))


def names(store):
    return {r.student_id: r.first_name for r in store.target().collect()}


def at(day):
    return {"updated_at": f"2031-05-{day:02}T00:00:00Z"}


@pytest.mark.parametrize("buckets", [1, 8])
def test_two_interleaved_merges_keep_both(spark, tmp_path, buckets):
    """Both read version 0; the second to commit computes again where a bucket was replaced."""
    store = StateStore(spark, str(tmp_path / "s"), buckets=buckets)
    builds = []

    def second(head):
        builds.append(head.version)
        if len(builds) == 1:  # while the second job works, the first one commits
            store.commit(lambda h: merge(spark, store, h, [(n, at(3) | {"first_name": "first"}) for n in range(6)], tmp_path)[1])
        return merge(spark, store, head, [(n, at(2 + n // 6 * 3) | {"first_name": "second"}) for n in range(4, 9)], tmp_path)[1]

    store.commit(second)
    want = {f"N{n:04}": "first" if n < 6 else "second" for n in range(9)}
    assert names(store) == want and store.head().version == 2
    assert builds == [0, 1]


def test_commits_beside_each_other_are_not_repeated(spark, tmp_path):
    """Another job's ledger rows and other buckets leave a computed merge as it is."""
    store = StateStore(spark, str(tmp_path / "s"), buckets=64)
    spread = {n: spark.range(1).selectExpr(f"pmod(xxhash64('N{n:04}'), 64) AS b").first().b for n in (1, 2)}
    assert spread[1] != spread[2]
    builds = []

    def build(head):
        builds.append(head.version)
        if len(builds) == 1:
            store.commit(lambda h: merge(spark, store, h, [(1, {})], tmp_path)[1])
            store.append_ledger(spark.createDataFrame([], ST.LEDGER_SCHEMA))
        return merge(spark, store, head, [(2, {})], tmp_path)[1]

    store.commit(build)
    assert builds == [0] and set(names(store)) == {"N0001", "N0002"} and store.head().version == 3


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), buckets=16)
    store.commit(lambda h: merge(spark, store, h, [(n, at(1)) for n in range(60)], tmp_path)[1])
    before, stored = store.head(), {r.student_id: r for r in store.target().collect()}
    assert len(before.target) > 10
    store.commit(lambda h: merge(spark, store, h, [(7, at(9) | {"first_name": "Other"}), (8, at(1))], tmp_path)[1])
    after = store.head()
    assert sum(before.target[b] != after.target[b] for b in before.target) == 1
    now = {r.student_id: r for r in store.target().collect()}
    assert now.pop("N0007").first_name == "Other" and stored.pop("N0007") and now == stored
    # nothing newer: no bucket is written, the version of the table stays
    actions, change = merge(spark, store, after, [(7, at(9)), (8, at(1))], tmp_path)
    assert not change.target and {r.action for r in actions.collect()} == {"skipped"}


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), buckets=4)
    store.commit(lambda h: merge(spark, store, h, [(n, at(1)) for n in range(20)], tmp_path)[1])
    keys = spark.createDataFrame([("N0003",)], "student_id string")
    kept = store.kept(store.head(), range(4), F.broadcast(keys))
    assert kept.count() == 19
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "ENSURE_REQUIREMENTS" not in plan.replace("BroadcastExchange", "")


def test_large_merges_need_no_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "BROADCAST_KEYS", 0)
    store = StateStore(spark, str(tmp_path / "s"), buckets=4)
    for day, span in ((1, range(12)), (2, range(6, 18))):
        store.commit(lambda h, d=day, s=span: merge(spark, store, h, [(n, at(d) | {"first_name": f"day{d}"}) for n in s], tmp_path)[1])
    assert names(store) == {f"N{n:04}": "day1" if n < 6 else "day2" for n in range(18)}


def test_versions_are_written_once(spark, tmp_path):
    files = ST.Files(spark, str(tmp_path))
    os.mkdir(tmp_path / "commits")
    name = f"{tmp_path}/commits/1.json"
    assert files.put_if_absent(name, "ä one") and not files.put_if_absent(name, "two")
    assert files.read(name) == "ä one" and [n for n, _ in files.names(f"{tmp_path}/commits") if not n.endswith(".crc")] == ["1.json"]
    assert files.names(f"{tmp_path}/nowhere") == []


def test_claims_of_two_jobs_started_together(spark, landing, tmp_path, monkeypatch):
    """The second job decides before the first one's claim is committed; each file is
    ingested by one of them."""
    root, state = landing({f"{k}.csv": FX.text([FX.record(k)]) for k in range(4)}), str(tmp_path / "s")
    original, first = StateStore.events, []

    def while_deciding(self, head, events):
        change = original(self, head, events)
        if not first:
            first.append(1)
            first.append(run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, correlation_id="one").collect())
        return change

    monkeypatch.setattr(StateStore, "events", while_deciding)
    landing({"late.csv": FX.text([FX.record(9)])})
    os.rename(os.path.join(root, "late.csv"), str(tmp_path / "late.csv"))
    second = run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, correlation_id="two").collect()
    assert {r.source_object for r in first[1]} == {f"{k}.csv" for k in range(4)} and second == []
    ledger = StateStore(spark, state).ledger().collect()
    assert {r.correlation_id for r in ledger} == {"one"} and {r.attempt for r in ledger} == {1}
    assert StateStore(spark, state).target().count() == 4


def test_overlapping_csv_and_api_jobs(spark, landing, tmp_path, monkeypatch):
    """The API job runs while the CSV job merges: rows, ledger and watermark of both stay."""
    import json

    state = str(tmp_path / "s")
    pages = tmp_path / "pages"
    pages.mkdir()
    api = [FX.record(n, **at(20)) | {"grade_level": 3} for n in (2, 3)]
    (pages / "p1.json").write_text(json.dumps({"students": api, "page": 1, "next_page": None}))
    root = landing({"a.csv": FX.text([FX.record(n, **at(10)) for n in (1, 2)])})
    original, ran = StateStore.merge, []

    def while_merging(self, *args, **kw):
        found = original(self, *args, **kw)
        if not ran:
            ran.append(1)
            run_api_job(spark, str(pages), state, as_of_sql=FX.AS_OF)
        return found

    monkeypatch.setattr(StateStore, "merge", while_merging)
    got = run_csv_job(spark, root, state, as_of_sql=FX.AS_OF).first()
    store = StateStore(spark, state)
    kept = {r.student_id: r.source_system for r in store.target().collect()}
    assert kept == {"N0001": S.CSV_SOURCE_SYSTEM, "N0002": S.API_SOURCE_SYSTEM, "N0003": S.API_SOURCE_SYSTEM}
    assert (got.inserted, got.updated, got.skipped) == (1, 0, 1)  # as merged after the API's rows
    assert {r.status for r in store.ledger().collect()} == {"completed"} and store.ledger().count() == 2
    assert [str(r.watermark) for r in store.checkpoints().collect()] == ["2031-05-20 00:00:00"]


def test_ledger_is_folded_and_upkeep(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "LEDGER_FOLDERS", 4)
    store = StateStore(spark, str(tmp_path / "s"), buckets=2)
    for k in range(7):
        event = {f.name: None for f in ST.LEDGER_SCHEMA.fields} | {"run_id": k % 3, "attempt": k, "phase": 0, "last_chunk": k, "status": "running"}
        store.append_ledger(spark.createDataFrame([tuple(event.values())], ST.LEDGER_SCHEMA))
    assert len(store.head().ledger) <= 4
    assert {r.run_id: r.last_chunk for r in store.ledger().collect()} == {0: 6, 1: 4, 2: 5}
    for day in (1, 2, 3):
        store.commit(lambda h, d=day: merge(spark, store, h, [(n, at(d)) for n in range(5)], tmp_path)[1])
    store.compact()
    want, head = names(store), store.head()
    lost = f"{store.root}/target/of-a-job-that-died"
    os.makedirs(lost)
    assert store.vacuum(keep_hours=1) == []
    gone = store.vacuum(keep_hours=0)
    assert not os.path.exists(lost) and len(gone) > 10
    assert names(store) == want and store.head() == head and store.ledger().count() == 3
    assert len([f for f in os.listdir(f"{store.root}/target") if not f.startswith(".")]) == 1
    assert len([f for f in os.listdir(f"{store.root}/commits") if f.endswith(".json")]) == 1


def test_died_between_folder_and_version(spark, landing, tmp_path, monkeypatch):
    """A job that dies after writing its buckets and before the version leaves the table as it
    was; under its own id it resumes."""
    root, state = landing({"a.csv": FX.text([FX.record(1)])}), str(tmp_path / "s")
    original, calls = ST.Files.put_if_absent, []

    def dies(self, name, text):
        calls.append(name)
        if len(calls) == 2:  # 1: the claim
            raise KeyboardInterrupt
        return original(self, name, text)

    monkeypatch.setattr(ST.Files, "put_if_absent", dies)
    with pytest.raises(KeyboardInterrupt):
        run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, correlation_id="mine")
    monkeypatch.setattr(ST.Files, "put_if_absent", original)
    store = StateStore(spark, state)
    assert store.target().count() == 0 and store.ledger().first().status == "running"
    assert run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, correlation_id="mine").first().inserted == 1
    assert jobs.StateStore(spark, state).target().count() == 1


def test_reports_read_their_pages_only(spark, tmp_path):
    """Rows lie by school, status and time, and a report's condition reaches the scan."""
    import re

    from test_plan_shapes import _plan

    from ingestry.operators import reports as O

    store = StateStore(spark, str(tmp_path / "s"), buckets=2)
    status = lambda n: "active" if n % 3 else "inactive"
    for day in (3, 4):
        store.commit(lambda h, d=day: merge(spark, store, h, [(n, at(d) | {"enrollment_status": status(n)}) for n in range(d, 90, d)], tmp_path)[1])
    store.compact()
    parts = store.target().selectExpr("_metadata.file_path AS f", "_metadata.row_index AS i", "*").collect()
    for f in {r.f for r in parts}:
        mine = [(r.school_id, r.enrollment_status, -r.updated_at.timestamp()) for r in sorted((r for r in parts if r.f == f), key=lambda r: r.i)]
        assert mine == sorted(mine) and len(mine) > 10
    report = O.newest(store.target(), k=5, where="school_id = 'BLDG-2' AND enrollment_status = 'active'")
    plan = _plan(spark, report)
    assert re.search(r"PushedFilters: .*EqualTo\(school_id,BLDG-2\), EqualTo\(enrollment_status,active\)", plan)
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    want = sorted((r for r in parts if r.school_id == "BLDG-2" and r.enrollment_status == "active"), key=lambda r: (-r.updated_at.timestamp(), r.student_id))[:5]
    assert [r.student_id for r in report.collect()] == [r.student_id for r in want]
