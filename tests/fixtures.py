"""Landing files made by rule: one sound record per number, with faults put in by name."""

import csv
import io

from ingestry.schema import CANONICAL_FIELDS

AS_OF = "TIMESTAMP'2031-06-01 00:00:00'"
NEXT_DAY = "TIMESTAMP'2031-06-02 00:00:00'"


def record(n, **changes):
    """Record number n, sound unless `changes` say otherwise."""
    return {
        "student_id": f"N{n:04d}",
        "first_name": f"Given{n}",
        "last_name": f"Family{n}",
        "grade_level": str(n % 12 + 1),
        "school_id": f"BLDG-{n % 4}",
        "email": f"n{n}@school.example",
        "enrollment_status": "active",
        "updated_at": f"2031-05-{n % 28 + 1:02d}T06:{n % 60:02d}:00Z",
        "guardian_contact": "",
    } | changes


def text(records, fields=CANONICAL_FIELDS, ending="\n"):
    """A CSV file of records (dicts, or lists of values as they are)."""
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=ending)
    writer.writerow(fields)
    for r in records:
        writer.writerow([r.get(f, "") for f in fields] if isinstance(r, dict) else r)
    return out.getvalue()


def values(r):
    return [r[f] for f in CANONICAL_FIELDS]


# Fault -> reason code and field, for one faulty record each.
FAULTS = {
    "enrollment_status": ({"enrollment_status": "astronaut"}, "UNKNOWN_ENROLLMENT_STATUS", "enrollment_status"),
    "grade": ({"grade_level": "23"}, "INVALID_GRADE_LEVEL", "grade_level"),
    "no school": ({"school_id": "   "}, "MISSING_REQUIRED_FIELD", "school_id"),
    "time": ({"updated_at": "May 3rd"}, "INVALID_TIMESTAMP", "updated_at"),
    "future": ({"updated_at": "2031-06-09T00:00:00Z"}, "INVALID_TIMESTAMP", "updated_at"),
    "email": ({"email": "no-at-sign"}, "INVALID_EMAIL", "email"),
    "long": ({"last_name": "x" * 101}, "FIELD_TOO_LONG", "last_name"),
}


def faulty(start=100):
    """One record per fault, a short and a long one, then two of one id: (records, expected
    {row ordinal: (reason, field)})."""
    rows, want = [], {}
    for k, (change, reason, field) in enumerate(FAULTS.values()):
        rows.append(record(start + k, **change))
        want[len(rows)] = (reason, field)
    rows.append(values(record(start + 20))[:5])
    want[len(rows)] = ("MALFORMED_ROW", None)
    rows.append(values(record(start + 21)) + ["one", "two, three"])
    want[len(rows)] = ("MALFORMED_ROW", None)
    rows.append(record(start + 30, updated_at="2031-05-02T00:00:00Z"))
    want[len(rows)] = ("DUPLICATE_STUDENT_ID", "student_id")
    rows.append(record(start + 30, updated_at="2031-05-03T00:00:00Z"))
    return rows, want
