"""Keyed state and timers in streams."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from ingestry.operators.alerts import quarantine_spike_stream
from ingestry.operators.dedupe import latest_per_key
from ingestry.operators.upsert import sequential_actions
from ingestry.streaming.absence import SHIPPED, missed_runs_stream
from ingestry.streaming.latest_state import latest_actions

ROWS = "student_id string, updated_at timestamp, o long"
LOGS = "timestamp timestamp, item_type string, message string"


def hour(n):
    return dt.datetime(2031, 5, 1) + dt.timedelta(hours=n)


def batches(seed, n):
    """Rows of n micro-batches; one key holds about a third of them."""
    rng, place = random.Random(seed), iter(range(10**6))
    return [[(rng.choice(["hot", "hot", *"abcd"]), hour(rng.randint(0, 30)), next(place)) for _ in range(60)] for _ in range(n)]


def folded(spark, stored, parts):
    """The same merge in one pass over chunks (W4), a micro-batch being a chunk."""
    rows = spark.createDataFrame([(*r, 0, k) for k, part in enumerate(parts) for r in part], f"{ROWS}, _f long, _c long")
    best = None
    for k in range(len(parts)):
        one = latest_per_key(rows.filter(f"_c = {k}"), key="student_id", ts="updated_at", tiebreak="o", count_as="n")
        best = one if best is None else best.unionByName(one)
    target = spark.createDataFrame(stored, "student_id string, updated_at timestamp")
    return sorted(
        (r.student_id, r.updated_at, r.o, r.action, r.n) for r in sequential_actions(target, best, seq=("_f", "_c")).collect()
    )


def put(spark, rows, schema, path, nth):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/b{nth}")
    time.sleep(0.02)  # files are taken by age


@pytest.mark.parametrize("stored", [[], [("a", hour(12)), ("hot", hour(29)), ("other", hour(1))]])
def test_latest_state_is_the_merge(spark, tmp_path, stored):
    parts, src, out = batches(len(stored), 5), str(tmp_path / "in"), str(tmp_path / "out")
    initial = spark.createDataFrame(stored, "student_id string, updated_at timestamp") if stored else None

    def run():
        rows = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        q = (latest_actions(rows, order="o", initial=initial).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(300)
        return sorted((r.student_id, r.updated_at, r.place, r.action, r.submitted) for r in spark.read.parquet(out).collect())

    for k in range(3):
        put(spark, parts[k], ROWS, src, k)
    assert run() == folded(spark, stored, parts[:3])
    for k in (3, 4):
        put(spark, parts[k], ROWS, src, k)
    assert run() == folded(spark, stored, parts)  # from the checkpoint
    assert run() == folded(spark, stored, parts)


def log(event, at, **more):
    import json

    return at, "trace", json.dumps({"event": event, **more})


def test_silence_raises_one_alert(spark, tmp_path):
    """One event is logged and falls silent, one is never logged; each is reported once, also
    over a restart, and again after it came back."""
    src, alerts = str(tmp_path / "logs"), str(tmp_path / "alerts")
    spark.createDataFrame([], LOGS).write.parquet(f"{src}/b0")
    begun = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    windows = {"one": 8 / 3600, "never": 10 / 3600}

    def start():
        logs = spark.readStream.schema(LOGS).parquet(f"{src}/*")
        since = f"TIMESTAMP'{begun:%Y-%m-%d %H:%M:%S}'"
        return (missed_runs_stream(logs, window_hours=windows, since_sql=since).writeStream.format("parquet").option("path", alerts)
                .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(processingTime="1 second").start())

    def raised():
        try:
            return sorted((r.event, r.last_seen) for r in spark.read.parquet(alerts).collect())
        except Exception as failure:  # noqa: BLE001 - nothing written yet
            assert "PATH_NOT_FOUND" in str(failure) or "Unable to infer schema" in str(failure)
            return []

    def until(n, seconds):
        end = time.time() + seconds
        while len(raised()) < n and time.time() < end:
            time.sleep(0.5)

    now = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    query = start()
    first = now()
    put(spark, [log("one", first), log("one", first - dt.timedelta(hours=1)), log("else", first)], LOGS, src, 1)
    until(2, 90)
    assert [e for e, _ in raised()] == ["never", "one"] and raised()[1][1] == first
    time.sleep(3)
    query.stop()
    query.awaitTermination(60)
    query = start()
    time.sleep(6)
    assert len(raised()) == 2
    again = now()
    put(spark, [log("one", again)], LOGS, src, 2)
    until(3, 90)
    time.sleep(3)
    query.stop()
    query.awaitTermination(60)
    assert raised() == sorted([("never", begun.replace(microsecond=0)), ("one", first), ("one", again)])
    assert set(SHIPPED) == {"M3", "M4"}


def test_quarantine_spike_stream(spark, tmp_path):
    rows = [log("quarantine.written", hour(h) + dt.timedelta(minutes=m), records=n) for h, m, n in
            [(1, 0, 60), (1, 59, 41), (2, 0, 100), (3, 5, "many"), (3, 6, 101)]]
    rows += [log("chunk.persisted", hour(2), records=500), log("quarantine.written", hour(9), records=1)]
    src = str(tmp_path / "logs")
    spark.createDataFrame(rows, LOGS).write.parquet(src)
    q = (quarantine_spike_stream(spark.readStream.schema(LOGS).parquet(src)).writeStream.format("memory").queryName("spikes_t")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    found = spark.table("spikes_t").select(F.col("window_start").cast("string").alias("w"), "total").collect()
    assert sorted((r.w, r.total) for r in found) == [("2031-05-01 01:00:00", 101), ("2031-05-01 03:00:00", 101)]


def test_micro_batches_are_written_and_folded_in_parts(spark, tmp_path, monkeypatch):
    """The input of a micro-batch isn't one task's, and three micro-batches it is all the same."""
    import glob

    from ingestry.plans import queries_jobs

    monkeypatch.setattr(queries_jobs, "scratch", lambda spark: str(tmp_path / "shared"))
    sf, held = str(tmp_path / "sf"), {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    rows = spark.range(0, 6000, 1, 6).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 60) AS ts", "id % 97 AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props"
    )
    rows.write.parquet(f"{sf}/events.parquet")
    old = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        got = queries_jobs.stream_merge_actions(spark, sf).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for g in range(3):
        assert len(glob.glob(f"{tmp_path}/shared/in/g={g}/*.parquet")) > 1
    seen = {}
    for r in got:
        seen.setdefault(r.student_id, []).append(r.action)
    assert all(a.count("inserted") == 1 and len(a) <= 3 for a in seen.values())
    assert max(map(len, seen.values())) == 3
