"""API pages end to end: envelope, page = chunk, watermark, and the life of a run."""

import json

import fixtures as FX
import pytest

from ingestry.plans.jobs import UnsafePages, StateStore, read_checkpoints, run_api_job


def pages(groups, **links):
    """One file per group of records, chained by page number unless `links` is given."""
    out = {}
    for k, group in enumerate(groups, 1):
        body = {"students": group} | (links or {"page": k, "next_page": k + 1 if k < len(groups) else None})
        out[f"p{k}.json"] = json.dumps(body)
    return out


def api(n, **changes):
    r = FX.record(n, **changes)
    return r | {"grade_level": int(r["grade_level"]), "profile": {"tongue": "pt", "flags": [n]}}


def rejects(spark, state):
    from ingestry.operators import quarantine as Q

    return [json.loads(r.record) for r in Q.read_back(spark, f"{state}/quarantine").collect()]


def test_two_runs(spark, landing, tmp_path):
    state = str(tmp_path / "state")
    late = api(9, updated_at="2031-05-31T00:00:00Z", email="broken")
    root = landing(pages([[api(1), api(2)], [], [api(2, updated_at="2031-05-20T00:00:00Z"), late]]))
    first = run_api_job(spark, root, state, as_of_sql=FX.AS_OF).first()
    assert (first.read, first.valid, first.quarantined, first.inserted, first.updated) == (4, 3, 1, 2, 1)
    rows = {r.student_id: r for r in StateStore(spark, state).target().collect()}
    assert json.loads(rows["N0001"].raw_payload) == api(1) and rows["N0001"].grade_level == 2
    # the quarantined record doesn't move the watermark
    assert [str(r.watermark) for r in read_checkpoints(spark, state).collect()] == ["2031-05-20 00:00:00"]
    assert rejects(spark, state) == [late]
    for name, body in pages([[api(1), api(5, updated_at="2031-05-21T00:00:00Z"), api(6, updated_at="?")]]).items():
        (tmp_path / "more").mkdir(exist_ok=True)
        (tmp_path / "more" / name).write_text(body)
    second = run_api_job(spark, str(tmp_path / "more"), state, as_of_sql=FX.NEXT_DAY).first()
    assert (second.read, second.inserted, second.quarantined) == (2, 1, 1)  # record 1 isn't newer than the watermark
    assert sorted(r["student_id"] for r in rejects(spark, state)) == ["N0006", "N0009"]
    ledger = StateStore(spark, state).ledger().collect()
    assert [r.status for r in ledger] == ["completed"] * 2 and {r.rows_read for r in ledger} == {4, 2}


def test_pages_with_cursors(spark, landing, tmp_path):
    groups = [[api(n, updated_at=f"2031-05-0{k}T00:00:00Z") for n in (1, k + 1)] for k in (1, 2, 3)]
    got = run_api_job(spark, landing(pages(groups, next="https://api.example/s?cursor=abc")), str(tmp_path / "s"), as_of_sql=FX.AS_OF).first()
    assert (got.read, got.inserted, got.updated, got.chunks) == (6, 4, 2, 3)


@pytest.mark.parametrize("body, why", [
    ({"page": 2, "next_page": 1, "data": []}, "non_advancing_next"),
    ({"page": 2, "next_page": "soon", "data": []}, "non_numeric_next"),
    ({"page": 2, "status": "no list"}, "no_record_list"),
])
def test_unsafe_pages_fail_the_run(spark, landing, tmp_path, body, why):
    root = landing(pages([[api(1)], [api(2)]]) | {"p2.json": json.dumps(body)})
    state = str(tmp_path / "state")
    with pytest.raises(UnsafePages, match=why):
        run_api_job(spark, root, state, as_of_sql=FX.AS_OF)
    run = StateStore(spark, state).ledger().first()
    assert run.status == "failed" and why in run.error and StateStore(spark, state).target_version() == 0
    assert read_checkpoints(spark, state).count() == 0
