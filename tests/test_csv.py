"""The landing reader keeps every row, whatever the file looks like (S3), and the cascade
over what it reads (V1-V10, W1/W2)."""

import json

import fixtures as FX
import pytest

from ingestry import schema as S
from ingestry.functions import payload as P
from ingestry.operators import core
from ingestry.sources import csv as CSV


def read(spark, root, **kw):
    return CSV.read_landing(spark, CSV.eligible_files(spark, root), **kw)


def batch(rows):
    return core.Batch(rows, as_of=FX.AS_OF, payload_sql=P.MAP_PAYLOAD_SQL, missing_sql=P.MAP_MISSING_SQL)


RECORDS = [FX.record(n, last_name=f"Line\n{n}" if n == 2 else 'Comma, "quoted"') for n in range(1, 5)]


@pytest.mark.parametrize("head, body", [(h, b) for h in ("\n", "\r\n", "\r") for b in ("\n", "\r\n", "\r", "\n\r\n", "\r\r")])
def test_every_mix_of_line_endings(spark, landing, head, body):
    first, rest = FX.text([]), FX.text(RECORDS, ending=body).split(body, 1)[1]
    root = landing({"m.csv": first.rstrip("\n") + head + rest})
    got = {r.student_id: (r._row_ordinal, r.last_name) for r in read(spark, root).collect()}
    assert got == {r["student_id"]: (k, r["last_name"]) for k, r in enumerate(RECORDS, 1)}


def test_long_and_odd_headers(spark, landing):
    many = [*S.CANONICAL_FIELDS, *(f"column {k} {'x' * 80}" for k in range(900))]
    odd = ["\n notes\nof two lines ", *reversed(S.CANONICAL_FIELDS), "EMAIL"]
    twice = FX.record(3) | {"EMAIL": "last@wins.example"}
    root = landing({
        "long.csv": FX.text([FX.record(1)], many),
        "odd.csv": FX.text([twice], odd),
        "bom.csv": "﻿" + FX.text([FX.record(5)], [f" {f.title()} " for f in S.CANONICAL_FIELDS]).replace(",,", ",", 0),
        "empty.csv": "", "head.csv": FX.text([]), "notes.txt": "a,b\n1,2\n",
    })
    rows = {r._source_object: r for r in read(spark, root).collect()}
    assert set(rows) == {"long.csv", "odd.csv", "bom.csv"}
    assert rows["long.csv"].student_id == "N0001" and len(rows["long.csv"]._src) == 909
    assert rows["odd.csv"].email == "last@wins.example" and "notes\nof two lines" in rows["odd.csv"]._src
    assert set(rows["bom.csv"]._src) == set(S.CANONICAL_FIELDS)


def test_surplus_and_missing_values(spark, landing):
    full = FX.values(FX.record(1))
    root = landing({"r.csv": FX.text([full + ["a, b", ""], full[:3], [], ["only", "a, quoted"]])})
    got = {r._row_ordinal: (r._extra_columns, r.last_name, r.grade_level, r._source_line) for r in read(spark, root).collect()}
    assert got == {1: (["a, b", ""], "Family1", "2", 2), 2: (None, "Family1", None, 3), 3: (None, None, None, 5)}


def test_faults(spark, landing):
    rows, want = FX.faulty()
    b = batch(read(spark, landing({"f.csv": FX.text(rows)})))
    got = {r.row_ordinal: (r.reason_code, r.field) for r in b.quarantine.collect()}
    assert got == want
    assert [str(r.updated_at) for r in b.students.collect()] == ["2031-05-03 00:00:00"]
    records = {r.row_ordinal: json.loads(r.record) for r in b.quarantine.collect()}
    assert records[9]["_extra_columns"] == ["one", "two, three"] and records[9]["_source_line"] == 10
    assert "_extra_columns" not in records[1] and records[8]["email"] is None
    dup = [r.detail for r in b.quarantine.collect() if r.reason_code == "DUPLICATE_STUDENT_ID"]
    assert dup == [
        "duplicate student_id in the same chunk; kept the row updated at "
        "2031-05-03T00:00:00+00:00 instead of 2031-05-02T00:00:00+00:00"
    ]


def test_chunks_bound_duplicates(spark, landing):
    rows = [FX.record(1, updated_at=f"2031-05-0{k}T00:00:00Z") for k in (1, 3, 2)]
    b = batch(read(spark, landing({"d.csv": FX.text(rows)}), chunk_size=2))
    assert sorted((r._chunk_index, r._row_ordinal) for r in b.students.collect()) == [(1, 2), (2, 3)]


def test_payload_keeps_source_spelling(spark, landing):
    r = FX.record(7, first_name="  Zoë ", grade_level="K", enrollment_status="Enrolled")
    (got,) = batch(read(spark, landing({"p.csv": FX.text([r])}))).students.collect()
    assert (got.first_name, got.grade_level, got.enrollment_status, got.guardian_contact) == ("Zoë", 0, "active", None)
    assert json.loads(got.raw_payload) == r and list(json.loads(got.raw_payload)) == list(S.CANONICAL_FIELDS)


def test_other_schema_is_rejected_row_by_row(spark, landing):
    root = landing({"w.csv": "room,teacher\n1,Ms A\n2,Mr B\n"})
    got = [(r.reason_code, r.field) for r in batch(read(spark, root)).quarantine.collect()]
    assert got == [("MISSING_REQUIRED_FIELD", "student_id")] * 2


def test_bodies_are_parsed_in_bounded_batches():
    import pyarrow as pa

    body = b"id,v\n" + b"".join(b"%d,x\n" % n for n in range(1, 3001))
    files = pa.RecordBatch.from_pydict({"name": ["a", "b", "c"], "body": [body, b"id\n", body]})
    got = list(CSV.parse_bodies(iter([files, files])))
    assert max(b.num_rows for b in got) <= CSV.BATCH_ROWS
    rows = [(r["source_object"], r["row_ordinal"], dict(r["src"])["id"]) for b in got for r in b.to_pylist()]
    assert rows == [(f, n, str(n)) for f in ("a", "c") * 2 for n in range(1, 3001)]
    assert list(CSV.parse_bodies(iter([files.slice(1, 1)]))) == []
