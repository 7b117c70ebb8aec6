"""Ledger claims (J2/J3), watermark monotonicity (K4), JSON envelopes (S4),
page-chain audit (S6) and upload naming (K6)."""

from ingestry.operators import ledger as L
from ingestry.sources import landing as LD
from ingestry.sources import pages as PG

AS_OF = "TIMESTAMP'2026-08-01 12:00:00'"


def test_claims(spark):
    listing = spark.createDataFrame(
        [("csv", f"f{i}", "v1:5000") for i in range(6)], "source string, source_object_id string, source_version string"
    )
    ledger = spark.sql(
        "SELECT * FROM VALUES "
        "(1, 'csv', 'f1', 'v1:5000', 'running', 2, TIMESTAMP'2026-08-01 11:30:00'),"
        "(2, 'csv', 'f2', 'v1:5000', 'completed', 9, TIMESTAMP'2026-08-01 10:00:00'),"
        "(3, 'csv', 'f3', 'v1:5000', 'failed', 3, TIMESTAMP'2026-08-01 10:00:00'),"
        "(4, 'csv', 'f4', 'v1:5000', 'running', 5, TIMESTAMP'2026-08-01 10:00:00'),"
        "(5, 'csv', 'f5', 'v0:5000', 'completed', 9, TIMESTAMP'2026-08-01 10:00:00') "
        "AS t(run_id, source, source_object_id, source_version, status, last_chunk, started_at)"
    )
    got = {r.source_object_id: (r.decision, r.resume_from) for r in L.claim_decisions(listing, ledger, as_of_sql=AS_OF).collect()}
    assert got == {
        "f0": ("new", 0), "f1": ("skipped", 0), "f2": ("skipped", 0),
        "f3": ("resumed", 3), "f4": ("stale_reclaimed", 5), "f5": ("new", 0),
    }
    assert sorted(r.source_object_id for r in L.claim_new(listing, ledger).collect()) == ["f0", "f5"]


def test_watermark_never_moves_back(spark):
    old = spark.sql("SELECT * FROM VALUES ('api', TIMESTAMP'2026-07-31 12:00:00'), ('x', TIMESTAMP'2026-07-01 00:00:00') AS t(source, watermark)")
    new = spark.sql("SELECT * FROM VALUES ('api', TIMESTAMP'2026-07-30 00:00:00'), ('y', TIMESTAMP'2026-07-02 00:00:00') AS t(source, watermark)")
    got = {r.source: (str(r.watermark), r.advanced) for r in L.advance_watermarks(old, new).collect()}
    assert got == {"api": ("2026-07-31 12:00:00", False), "x": ("2026-07-01 00:00:00", False), "y": ("2026-07-02 00:00:00", True)}


def test_envelopes(spark):
    bodies = [
        (1, '{"data": [{"student_id": "a"}, null, 3]}'),
        (2, '{"students": [{"student_id": "b"}]}'),
        (3, '{"items": [{"student_id": "c"}]}'),
        (4, '{"results": [{"student_id": "d", "profile": {"iep": false}}]}'),
        (5, '[{"student_id": "e"}]'),
        (6, '{"data": {"student_id": "x"}, "results": [{"student_id": "f"}]}'),
        (7, '{"nothing": 1}'),
    ]
    pages = spark.createDataFrame(bodies, "page_id int, body string")
    out = PG.extract_records(pages, keep=("page_id",)).selectExpr(
        "page_id", "try_variant_get(item, '$.student_id', 'string') AS sid", "page_error",
        "try_variant_get(item, '$.profile.iep', 'boolean') AS iep").collect()
    got = sorted((r.page_id, r.sid) for r in out if r.page_error is None)
    assert got == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f")]
    assert [r.page_id for r in out if r.page_error] == [7]
    assert [r.iep for r in out if r.page_id == 4] == [False]


def test_page_chain(spark):
    pages = spark.createDataFrame(
        [(1, 1, "2", None), (1, 2, None, "https://x/s?page=3"), (1, 3, "3", None),
         (2, 1, "abc", None), (3, 1, "2", None), (3, 1, "2", None), (3, 2, "4", None)],
        "run_id int, page int, next_page string, next_url string")
    got = sorted((r.run_id, r.page, r.problem) for r in PG.chain_violations(pages).collect())
    assert got == [(1, 3, "non_advancing_next"), (2, 1, "non_numeric_next"), (3, 1, "repeated_page"), (3, 2, "missing_page")]


def test_upload_names(spark):
    names = ["../bad path/students final.csv", "roster.XLSX", "scan.pdf", "p.JPG", "n.docx", "d.txt", "...", "a\\\\b\\\\c.CSV"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    out = LD.upload_triage(df, name="n", now_sql="TIMESTAMP'2026-08-01 08:30:00'", unique_id_sql="'abc'").orderBy("i").collect()
    assert out[0].object_name == "uploads/20260801T083000Z-abc-students-final.csv"
    assert [r.message for r in out[1:7]] == [
        "Excel files are not supported yet. Export as CSV.",
        "PDF files are not supported yet. Export as CSV.",
        "Image files are not supported yet. Export as CSV.",
        "Word documents are not supported yet. Export as CSV.",
        "uploaded file type is not supported yet. Export as CSV.",
        "filename is empty",
    ]
    assert out[7].object_name == "uploads/20260801T083000Z-abc-c.CSV"
