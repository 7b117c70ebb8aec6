"""Jobs over a state folder: claims, isolation, replay, archive; and the stream."""

import json
import os

import fixtures as FX
import pytest

from ingestry import schema as S
from ingestry.operators import audit as V
from ingestry.operators import quarantine as Q
from ingestry.plans import jobs
from ingestry.plans.jobs import FilesFailed, StateStore, run_csv_job
from ingestry.sources import csv as CSV
from ingestry.streaming import landing as STREAM


def put(root, name, body):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body.encode() if isinstance(body, str) else body)


def summary(df):
    return {r.source_object: r for r in df.collect()}


def stored(spark, state):
    return {r.student_id: r for r in StateStore(spark, state).target().collect()}


def test_job_and_replay(spark, landing, tmp_path):
    rows, want = FX.faulty()
    root = landing({
        "sub/a.csv": FX.text([FX.record(n) for n in range(6)]), "b.csv": FX.text(rows), "c.csv": "room\n1\n2\n",
        "empty.csv": "", "head.csv": FX.text([]),
    })
    state = str(tmp_path / "state")
    got = summary(run_csv_job(spark, root, state, as_of_sql=FX.AS_OF))
    assert {k: (r.read, r.valid, r.quarantined, r.inserted) for k, r in got.items()} == {
        "sub/a.csv": (6, 6, 0, 6), "b.csv": (len(rows), 1, len(want), 1), "c.csv": (2, 0, 2, 0),
        "empty.csv": (0, 0, 0, 0), "head.csv": (0, 0, 0, 0),
    }
    assert {r.run_status for r in got.values()} == {"completed"}
    ledger = {r.source_object_id: r for r in StateStore(spark, state).ledger().collect()}
    assert ledger["b.csv"].rows_quarantined == len(want) and ledger["b.csv"].last_chunk == 1 and len(ledger) == 5
    before, version = stored(spark, state), StateStore(spark, state).target_version()
    assert run_csv_job(spark, root, state, as_of_sql=FX.NEXT_DAY).count() == 0
    assert stored(spark, state) == before and StateStore(spark, state).target_version() == version
    back = Q.read_back(spark, state + "/quarantine")
    assert back.count() == len(want) + 2
    store = StateStore(spark, state)
    assert V.stored_violations(store.target()).count() == 0 and V.ledger_violations(store.ledger()).count() == 0
    worse = store.target().selectExpr("* EXCEPT (grade_level, email)", "99 AS grade_level", "CAST(NULL AS STRING) AS email")
    twice = worse.unionAll(worse)
    names = {r.violation for r in V.stored_violations(twice).collect()}
    assert names == {"grade_level_range", "email_not_null", "student_id_unique"}
    runs = store.ledger()
    bad = runs.unionAll(runs.selectExpr("* EXCEPT (status)", "'odd' AS status").select(*runs.columns))
    assert {r.violation for r in V.ledger_violations(bad).collect()} == {"status_enum", "identity_unique"}


def test_header_names_cannot_collide(spark, landing, tmp_path):
    odd = ["parent's phone", "version", "run", "path", "detail", "field", "reason_code", "resume_from", "", "a`b", "_src", "_valid"]
    root = landing({
        "odd.csv": FX.text([FX.record(1) | {f: f"v-{f}" for f in odd}, FX.record(2, email="bad")], [*S.CANONICAL_FIELDS, *odd]),
        "sound.csv": FX.text([FX.record(3)]),
    })
    state = str(tmp_path / "s")
    got = summary(run_csv_job(spark, root, state, as_of_sql=FX.AS_OF))
    assert (got["odd.csv"].inserted, got["odd.csv"].quarantined, got["sound.csv"].inserted) == (1, 1, 1)
    payload = json.loads(stored(spark, state)["N0001"].raw_payload)
    assert {f: payload[f] for f in odd} == {f: f"v-{f}" for f in odd}


def test_failed_file_fails_alone(spark, landing, tmp_path):
    """Bytes that aren't UTF-8 behind two whole chunks: those stay, the rest waits."""
    sound = FX.text([FX.record(n) for n in range(20, 4000)])
    root = landing({"bad.csv": sound.encode() + b"\xff\xfe" + b"x" * 20_000, "good.csv": FX.text([FX.record(1)])})
    state = str(tmp_path / "s")
    with pytest.raises(FilesFailed, match="1 CSV file.* bad.csv") as failure:
        run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, chunk_size=1000, processed_root=str(tmp_path / "done"))
    got = summary(failure.value.summaries)
    assert got["good.csv"].run_status == "completed" and got["bad.csv"].run_status == "failed"
    assert "UnicodeDecodeError" in got["bad.csv"].error and got["bad.csv"].chunks == 3
    ledger = {r.source_object_id: r for r in StateStore(spark, state).ledger().collect()}
    assert (ledger["bad.csv"].status, ledger["bad.csv"].last_chunk, ledger["bad.csv"].rows_read) == ("failed", 3, 3000)
    assert len(stored(spark, state)) == 3001
    assert os.path.exists(os.path.join(root, "bad.csv")) and not os.path.exists(os.path.join(root, "good.csv"))
    again = run_csv_job(spark, root, state, as_of_sql=FX.NEXT_DAY, chunk_size=1000, raise_on_failure=False)
    assert summary(again)["bad.csv"].read == 0  # resumed behind chunk 3
    assert StateStore(spark, state).ledger().filter("source_object_id = 'bad.csv'").first().rows_read == 3000


@pytest.mark.parametrize("body", [FX.text([FX.record(n) for n in range(9)]), ""])
def test_changed_file_fails_alone_then_completes(spark, landing, tmp_path, monkeypatch, body):
    root = landing({"a.csv": FX.text([FX.record(1)]), "b.csv": FX.text([FX.record(2)])})
    original, state = CSV.read_files, str(tmp_path / "s")

    def after_change(files, **kw):
        put(root, "b.csv", body)
        return original(files, **kw)

    monkeypatch.setattr(jobs.CSV, "read_files", after_change)
    got = summary(run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, raise_on_failure=False))
    assert (got["a.csv"].run_status, got["b.csv"].run_status, got["b.csv"].read) == ("completed", "failed", 0)
    assert got["b.csv"].error == CSV.CHANGED and set(stored(spark, state)) == {"N0001"}
    monkeypatch.setattr(jobs.CSV, "read_files", original)
    second = summary(run_csv_job(spark, root, state, as_of_sql=FX.NEXT_DAY))
    assert set(second) == {"b.csv"} and second["b.csv"].inserted == max(0, body.count("\n") - 2)


def test_running_claim_is_respected(spark, landing, tmp_path, monkeypatch):
    """A job that dies after its claim holds the files until the claim is stale; under its
    own correlation id it resumes at once."""
    root, state = landing({"a.csv": FX.text([FX.record(1)])}), str(tmp_path / "s")
    original = jobs._commit

    def dies(*args, **kw):
        raise KeyboardInterrupt

    monkeypatch.setattr(jobs, "_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, correlation_id="mine")
    monkeypatch.setattr(jobs, "_commit", original)
    assert StateStore(spark, state).ledger().first().status == "running"
    assert run_csv_job(spark, root, state, as_of_sql=FX.AS_OF).count() == 0
    assert run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, correlation_id="mine").first().inserted == 1
    assert StateStore(spark, state).ledger().first().status == "completed"


def test_new_version_and_older_rows(spark, landing, tmp_path):
    root, state = landing({"a.csv": FX.text([FX.record(n) for n in range(1, 5)])}), str(tmp_path / "s")
    run_csv_job(spark, root, state, as_of_sql=FX.AS_OF)
    old, new = "2030-01-01T00:00:00Z", "2031-05-31T00:00:00Z"
    put(root, "a.csv", FX.text([FX.record(1, updated_at=old), FX.record(2, updated_at=new, first_name="Other"), FX.record(3), FX.record(9)]))
    got = run_csv_job(spark, root, state, as_of_sql=FX.NEXT_DAY).first()
    assert (got.inserted, got.updated, got.skipped) == (1, 1, 2)
    rows = stored(spark, state)
    assert rows["N0002"].first_name == "Other" and str(rows["N0001"].updated_at).startswith("2031")
    assert str(rows["N0002"].ingested_at) == "2031-06-01 00:00:00" and str(rows["N0002"].last_written_at) == "2031-06-02 00:00:00"


def test_order_across_chunks_and_files(spark, landing, tmp_path):
    at = lambda d: f"2031-05-{d:02d}T00:00:00Z"
    root = landing({
        "1.csv": FX.text([FX.record(1, updated_at=at(1)), FX.record(2, updated_at=at(5)), FX.record(1, updated_at=at(2))]),
        "2.csv": FX.text([FX.record(2, updated_at=at(5)), FX.record(3, updated_at=at(1))]),
    })
    got = summary(run_csv_job(spark, root, str(tmp_path / "s"), chunk_size=2, as_of_sql=FX.AS_OF))
    assert [(r.inserted, r.updated, r.skipped) for r in (got["1.csv"], got["2.csv"])] == [(2, 1, 0), (1, 0, 1)]


def test_archive(spark, landing, tmp_path, monkeypatch):
    root, state, done = landing({"a.csv": FX.text([FX.record(1)]), "sub/e.csv": ""}), str(tmp_path / "s"), str(tmp_path / "done")
    run_csv_job(spark, root, state, as_of_sql=FX.AS_OF, processed_root=done)
    assert os.path.exists(f"{done}/a.csv") and os.path.exists(f"{done}/sub/e.csv") and not os.path.exists(f"{root}/a.csv")
    put(root, "only-empty.csv", "")
    run_csv_job(spark, root, state, as_of_sql=FX.NEXT_DAY, processed_root=done)
    assert os.path.exists(f"{done}/only-empty.csv")
    put(root, "late.csv", FX.text([FX.record(2)]))
    put(str(tmp_path), "file-in-the-way", "x")
    run_csv_job(spark, root, state, as_of_sql=FX.NEXT_DAY, processed_root=str(tmp_path / "file-in-the-way"))
    assert [r.name for r in spark.read.json(f"{state}/archive_failures").collect()] == ["late.csv"]


def test_moves_repeat_harmlessly(spark, landing, tmp_path):
    """As when the task that moved them is lost: what is in its new place is done."""
    from ingestry.sources import landing as LD

    root, done = landing({"a.csv": "a\n1\n", "sub/b.csv": "", "c.csv": "a\n"}), str(tmp_path / "done")
    files = spark.createDataFrame(LD.list_objects(spark, root).collect())
    assert {r.name for r in LD.archive(files, done).filter("moved").collect()} == {"a.csv", "sub/b.csv", "c.csv"}
    assert LD.archive(files, done).filter("NOT moved").count() == 0
    os.remove(f"{done}/a.csv")
    put(root, "sub/b.csv", "other")
    left = {r.name: r.reason for r in LD.archive(files, done).filter("NOT moved").collect()}
    assert left == {"a.csv": "not found", "sub/b.csv": "changed since it was listed"}


def test_rejects_lie_by_attempt(spark, landing, tmp_path):
    """One folder an attempt, whatever the number of chunks; a repeated attempt replaces its own."""
    rows = [FX.record(n, email="bad") if n % 2 else FX.record(n) for n in range(60)]
    root, state = landing({"a.csv": FX.text(rows)}), str(tmp_path / "s")
    run_csv_job(spark, root, state, chunk_size=5, as_of_sql=FX.AS_OF)
    folders = [d for d, _, names in os.walk(f"{state}/quarantine") if any(n.endswith(".txt") for n in names)]
    assert len(folders) == 1 and folders[0].endswith("from_chunk=0")
    back = Q.read_back(spark, f"{state}/quarantine")
    assert sorted(r.chunk_index for r in back.collect()) == sorted(n // 5 + 1 for n in range(60) if n % 2)
    again = spark.createDataFrame([("csv", 7, "f", "E_BAD", 0, 1, "{}")], "source_system string, run long, source_object string, reason_code string, from_chunk long, chunk_index long, record string")
    for _ in range(2):
        Q.write(again.selectExpr("*", "'d' AS detail", "'x' AS field"), f"{state}/quarantine", run_id_col="run", correlation_id="c")
    assert back.sparkSession and Q.read_back(spark, f"{state}/quarantine").filter("run_id = '7'").count() == 1
    assert Q.read_back(spark, f"{state}/quarantine").count() == 31


def test_large_job(spark, landing, tmp_path):
    root, state = landing({"big.csv": FX.text([FX.record(n) for n in range(50_000)])}), str(tmp_path / "s")
    got = run_csv_job(spark, root, state, as_of_sql=FX.AS_OF).first()
    assert (got.read, got.valid, got.inserted, got.chunks) == (50_000, 50_000, 10_000 + 40_000, 10)
    assert StateStore(spark, state).target().count() == 50_000


def test_one_read_of_the_landing_files(spark, landing, tmp_path, monkeypatch):
    calls, original = [], CSV.read_files
    monkeypatch.setattr(jobs.CSV, "read_files", lambda files, **kw: calls.append(1) or original(files, **kw))
    run_csv_job(spark, landing({f"{k}.csv": FX.text([FX.record(k)], [*S.CANONICAL_FIELDS, f"c{k}"]) for k in range(4)}), str(tmp_path / "s"), as_of_sql=FX.AS_OF)
    assert len(calls) == 1


def test_stream(spark, landing, tmp_path):
    swapped = ["last_name", "first_name", *[f for f in S.CANONICAL_FIELDS if f not in ("first_name", "last_name")]]
    short = FX.values(FX.record(50, first_name="A, B", last_name="C, D, E, F, G, H"))[:6]
    root = landing({
        "uploads/s1.csv": FX.text([FX.record(1), FX.record(2)], ending="\r"),
        "s2.csv": FX.text([FX.record(3)], swapped), "x/s2.csv": FX.text([FX.record(4, updated_at="2031-05-30T00:00:00Z")]),
        "bad.csv": FX.text([short, FX.values(FX.record(51)) + ["real", "surplus"]]),
    })
    state, kw = str(tmp_path / "state"), {"checkpoint": str(tmp_path / "ckpt"), "as_of_sql": FX.AS_OF}
    STREAM.start(spark, root, state, **kw).awaitTermination(300)
    rows = stored(spark, state)
    assert set(rows) == {"N0001", "N0002", "N0003", "N0004"} and rows["N0003"].first_name == "Given3"
    back = [json.loads(r.record) | {"why": r.detail} for r in Q.read_back(spark, f"{state}/quarantine").collect()]
    assert sorted(r["why"] for r in back) == [S.DETAIL_FEWER_VALUES, S.DETAIL_MORE_VALUES]
    assert [r["_extra_columns"] for r in back if "_extra_columns" in r] == [["real", "surplus"]]
    assert {r.source_object_id for r in StateStore(spark, state).ledger().filter("status = 'completed'").collect()} == {
        "uploads/s1.csv", "s2.csv", "x/s2.csv", "bad.csv"}
    STREAM.start(spark, root, state, **kw).awaitTermination(300)
    assert stored(spark, state) == rows


def test_failure_alert_stream(spark, tmp_path):
    import datetime as dt

    from ingestry.operators.alerts import pipeline_failures_stream

    src, schema = tmp_path / "logs", "timestamp timestamp, item_type string, message string"
    rows = [
        (dt.datetime(2031, 5, 1, 10, 1), "trace", '{"event": "CSV.File_Failed_late"}'),
        (dt.datetime(2031, 5, 1, 10, 2), "exception", "{}"),
        (dt.datetime(2031, 5, 1, 10, 7), "trace", '{"event": "chunk.persisted"}'),
        (dt.datetime(2031, 5, 1, 11, 0), "trace", '{"event": "api.sync_failed"}'),
    ]
    spark.createDataFrame(rows, schema).write.parquet(str(src))
    q = (pipeline_failures_stream(spark.readStream.schema(schema).parquet(str(src))).writeStream.format("memory")
         .queryName("fail_alerts_t").outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert ("2031-05-01 10:00:00", 2) in [(str(r.window_start), r.failures) for r in spark.table("fail_alerts_t").collect()]


def test_missed_runs_without_logs_and_after_the_last(spark):
    import datetime as dt

    from ingestry.operators.alerts import missed_runs

    schema = "timestamp timestamp, message string, item_type string"
    kw = {"event": "done", "window_hours": 2, "as_of_sql": "TIMESTAMP'2031-05-02 00:30:00'", "lookback_hours": 12}
    assert missed_runs(spark.createDataFrame([], schema), **kw).count() == 12
    logs = spark.createDataFrame([(dt.datetime(2031, 5, 1, 20, 10), '{"event": "done"}', "trace")], schema)
    ends = sorted(str(r.window_end)[5:13] for r in missed_runs(logs, **kw).collect())
    assert ends == [f"05-01 {h}" for h in range(13, 21)] + ["05-01 23", "05-02 00"]


def test_numbers_run_through_all_ranges(spark, tmp_path):
    names = [f"f{n:04}" for n in range(700)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = jobs._numbered(df, "name", "nth", str(tmp_path / "n"))
        assert len({r.name: r.nth for r in got.collect()}) == 700
        assert [r.name for r in got.orderBy("nth").collect()] == names
        assert got.selectExpr("min(nth)", "max(nth)", "count(DISTINCT nth)").first() == (1, 700, 700)
        assert jobs._numbered(df.limit(0), "name", "nth", str(tmp_path / "none")).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
