"""The page source: resumes behind committed pages, waits for missing ones, refuses broken chains."""

import json

import fixtures as FX
import pytest

from ingestry.plans.jobs import StateStore, read_checkpoints
from ingestry.sources import page_stream as PS
from ingestry.streaming import pages as STREAM


def put(root, number, records, **links):
    root.mkdir(exist_ok=True)
    (root / f"page-{number:03}.json").write_text(json.dumps({"students": records, "page": number} | links))


def record(n, day=1):
    return FX.record(n, updated_at=f"2031-05-{day:02}T00:00:00Z") | {"grade_level": n % 12 + 1}


def run(spark, root, tmp_path):
    q = STREAM.start(spark, str(root), str(tmp_path / "state"), checkpoint=str(tmp_path / "ck"), as_of_sql=FX.AS_OF)
    q.awaitTermination(300)
    return {r.student_id: r.first_name for r in StateStore(spark, str(tmp_path / "state")).target().collect()}


def test_resumes_without_repeats(spark, tmp_path):
    root = tmp_path / "pages"
    put(root, 1, [record(1), "not a record", record(2)], next_page=2)
    put(root, 2, [record(3)], next_page=3)
    put(root, 4, [record(9)], next_page=5)  # page 3 is not there yet
    assert set(run(spark, root, tmp_path)) == {"N0001", "N0002", "N0003"}
    put(root, 1, [record(7)], next_page=2)  # read already: not read again
    put(root, 3, [record(1, day=2) | {"first_name": "Newer"}], next_page=4)
    assert run(spark, root, tmp_path) == {"N0001": "Newer", "N0002": "Given2", "N0003": "Given3", "N0009": "Given9"}
    store = StateStore(spark, str(tmp_path / "state"))
    before = store.head()
    assert run(spark, root, tmp_path) and store.head() == before  # nothing new
    runs = store.ledger().collect()
    assert {r.status for r in runs} == {"completed"} and sorted(r.rows_read for r in runs) == [2, 3]
    assert [str(r.watermark) for r in read_checkpoints(spark, store.root).collect()] == ["2031-05-02 00:00:00"]


def test_replayed_batch_is_skipped(spark, tmp_path):
    from ingestry.plans.jobs import ingest_records

    rows = spark.createDataFrame([(1, 0, json.dumps(record(1)))], PS.SCHEMA)
    state = str(tmp_path / "s")
    assert ingest_records(spark, rows, state, run_id="b-0", as_of_sql=FX.AS_OF).first().inserted == 1
    version = StateStore(spark, state).head().version
    assert ingest_records(spark, rows, state, run_id="b-0", as_of_sql=FX.AS_OF).count() == 0
    assert StateStore(spark, state).head().version == version


@pytest.mark.parametrize("links, why", [
    ({"next_page": 1}, "its next page is 1"), ({"next_page": 7}, "its next page is 7"), ({"next_page": "soon"}, "not a number"),
    ({"next": "https://api.example/s?page=9"}, "its next page is 9"), ({"next_page": None}, "it is the last"), ({"page": 5}, "its body says 5"),
    ({"students": "none"}, "record list"),
])
def test_broken_chain_fails_the_query(spark, tmp_path, links, why):
    root = tmp_path / "pages"
    put(root, 1, [record(1)], **links)
    put(root, 2, [record(2)])
    with pytest.raises(Exception, match=why):
        run(spark, root, tmp_path)
    assert StateStore(spark, str(tmp_path / "state")).target().count() == 0


def test_links_and_offsets(tmp_path):
    assert PS.next_number([]) is None and PS.next_number({"next_page": "12"}) == 12
    assert PS.next_number({"next_url": "x?a=1&page=3", "next_page": 9}) == 3 and PS.next_number({"next": "x?cursor=ab"}) is None
    for n in (1, 2, 4):
        put(tmp_path, n, [])
    reader = PS.PageStream(str(tmp_path), 1)
    assert reader.latestOffset() == {"pages": 2} and reader.initialOffset() == {"pages": 0}
    assert [p.number for p in reader.partitions({"pages": 1}, {"pages": 2})] == [2] and reader.partitions({"pages": 2}, {"pages": 2}) == []
    with pytest.raises(PS.BrokenChain, match="gone"):
        reader.partitions({"pages": 2}, {"pages": 3})
    assert PS.PageStream(str(tmp_path), 4).latestOffset() == {"pages": 1}
