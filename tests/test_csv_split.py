"""A file cut into byte ranges is the file read from its beginning (S3)."""

import csv
import io
import os
import random

import fixtures as FX
import pytest

from ingestry import schema as S
from ingestry.plans.jobs import FilesFailed, StateStore, run_csv_job
from ingestry.sources import csv as CSV


def odd_body(rng, size):
    """Values with quotes at odd places, breaks inside quotes and every line ending."""
    parts = ["id", ",", "b", rng.choice(["\n", "\r\n", "\r"])]
    while sum(map(len, parts)) < size:
        parts.append(rng.choice(['"', '""', ',', "\n", "\r\n", "\r", "ab", "ä€", '"x\ny"', '"\r\n"', "c" * rng.randint(1, 30), '"",', " "]))
    return "".join(parts).encode()


def sequential(body):
    return [(n, line, values, extra) for n, (line, values, extra) in enumerate(CSV.parse(io.BytesIO(body)), 1)]


def found(spark, root, split):
    pieces = CSV.read_files(CSV.eligible_files(spark, root), split=split)
    rows = {}
    for r in CSV.numbered(pieces).collect():
        rows.setdefault(os.path.basename(r.path), []).append((r._row_ordinal, r._source_line, r._src, r._extra_columns))
    closing = {os.path.basename(r.path): r for r in CSV.closings(pieces, split=split).collect()}
    return {k: sorted(v, key=lambda x: x[0]) for k, v in rows.items()}, closing


@pytest.mark.parametrize("split", [7, 64, 1000])
def test_ranges_of_random_bytes(spark, landing, split):
    rng = random.Random(split)
    bodies = {f"{k}.csv": odd_body(rng, rng.randint(20, 60 * split)) for k in range(8)}
    bodies |= {"bom.csv": CSV._BOM + b"a,b\n1,\xc3\xa9\n" * 9, "none.csv": b"", "head.csv": b"a,b", "blank.csv": b"a,b\n\n\r\n\n1,2\n\n"}
    bodies |= {"quoted.csv": b'a,b\n1,"' + b"long\n" * 3 * split + b'"\n2,3\n', "open.csv": b'a\n1\n"2\n3\n' * 4, "line.csv": b"a\n" + b"x" * 5 * split}
    rows, closing = found(spark, landing(bodies), split)
    for name, body in bodies.items():
        want = sequential(body)
        assert rows.get(name, []) == want, name
        assert (closing[name]._rows, closing[name]._usable, closing[name]._error) == (len(want), len(want), None)
        assert closing[name]._digest.startswith(f"{split}:")


def test_state_behind_whole_lines():
    rng = random.Random(3)
    for _ in range(400):
        data = odd_body(rng, rng.randint(1, 60)) + b"\n"
        for quoted in (False, True):
            probe = csv.reader(io.StringIO(('"' if quoted else "") + data.decode() + "\x00end", newline=""))
            last = list(probe)[-1]
            assert CSV.ends_in_quotes(data, quoted) == (last != ["\x00end"]), (data, quoted)


def test_fault_inside_a_range(spark, landing):
    """Rows before the bytes that aren't UTF-8 count, whichever range they are in."""
    sound = FX.text([FX.record(n) for n in range(50)]).encode()
    cut = sound.index(b"N0030")
    body = sound[:cut] + b"\xff" + sound[cut:]
    for split in (100, 1500, 1 << 20):
        rows, closing = found(spark, landing({"f.csv": body}), split)
        got = closing["f.csv"]
        assert got._usable == 30 and "UnicodeDecodeError" in got._error
        assert [r[2]["student_id"] for r in rows["f.csv"][:30]] == [f"N{n:04}" for n in range(30)]


def test_many_tasks_for_one_file(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(CSV, "SPLIT_BYTES", 20_000)
    monkeypatch.setattr(CSV, "TASK_BYTES", 40_000)
    records = [FX.record(n, last_name=f"Two\nlines {n}" if n % 5 == 0 else "One") for n in range(3000)]
    root = landing({"big.csv": FX.text(records)})
    pieces = CSV.read_files(CSV.eligible_files(spark, root), split=20_000)
    assert pieces.rdd.getNumPartitions() >= 4
    rows = CSV.numbered(pieces).collect()
    assert [r._src["student_id"] for r in sorted(rows, key=lambda r: r._row_ordinal)] == [f"N{n:04}" for n in range(3000)]


def test_same_size_and_time_but_other_bytes(spark, landing, tmp_path, monkeypatch):
    """A run that resumes behind committed chunks refuses other bytes; the other file goes on."""
    from ingestry.plans import jobs

    first = FX.text([FX.record(n) for n in range(30)])
    root, state = landing({"a.csv": first + "\n\n", "b.csv": FX.text([FX.record(90)])}), str(tmp_path / "s")
    path = os.path.join(root, "a.csv")
    body = open(path, "rb").read()
    with open(path, "wb") as f:
        f.write(body[:-2] + b"\xff\n")
    stamp = os.stat(path)
    with pytest.raises(FilesFailed):
        run_csv_job(spark, root, state, chunk_size=10, as_of_sql=FX.AS_OF)
    ledger = {r.source_object_id: r for r in StateStore(spark, state).ledger().collect()}
    assert ledger["a.csv"].last_chunk == 3 and ledger["a.csv"].content_digest
    with open(path, "wb") as f:
        f.write(body.replace(b"Given29", b"Other29"))
    os.utime(path, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    with pytest.raises(FilesFailed) as failure:
        run_csv_job(spark, root, state, chunk_size=10, as_of_sql=FX.NEXT_DAY)
    got = {r.source_object: r for r in failure.value.summaries.collect()}
    assert got["a.csv"].error == jobs.OTHER_BYTES and got["a.csv"].read == 0 and set(got) == {"a.csv"}
    assert StateStore(spark, state).target().filter("first_name = 'Other29'").count() == 0
    with open(path, "wb") as f:
        f.write(body[:-2] + b"\xff\n")
    os.utime(path, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    with pytest.raises(FilesFailed, match="a.csv"):  # the bytes of the first attempt resume
        run_csv_job(spark, root, state, chunk_size=10, as_of_sql=FX.NEXT_DAY)
    assert StateStore(spark, state).ledger().filter("source_object_id = 'a.csv'").first().last_chunk == 3
    assert S.CHUNK_INDEX


def test_rows_stay_where_they_are_when_numbered(spark, landing):
    """Numbering joins no two large sides, and as many ranges go to each task."""
    from pyspark.sql import functions as F

    root = landing({f"f{k}.csv": "student_id\n" + "".join(f"S{n:05}\n" for n in range(400)) for k in range(4)})
    pieces = CSV.read_files(CSV.eligible_files(spark, root), split=300)
    rows = CSV.numbered(pieces)
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        plan = rows.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    got = sorted((r.path[-6:], r._row_ordinal, r._src["student_id"]) for r in rows.collect())
    assert got == [(f"f{k}.csv", n + 1, f"S{n:05}") for k in range(4) for n in range(400)]
    dealt = pieces.filter("_row_ordinal IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) <= min(r["count"] for r in dealt) + 1
