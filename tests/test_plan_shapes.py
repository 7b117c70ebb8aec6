"""Plan-shape guards for the scale decisions (checked with the executed plan)."""

import re

from ingestry.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_cascade_runs_once_and_fits_codegen(spark):
    # direct split: the filter stays above the cascade projection (barrier referenced)
    plan = _plan(spark, QUERIES["valid_records"](spark, SF))
    # the parsers have six patterns (e-mail, two of grades, three of times), each there once
    assert "_task" in plan and plan.count("RLIKE") <= 6
    # dedupe: one shuffle keyed by (file, chunk) in front of the cascade serves the windows too
    plan = _plan(spark, QUERIES["dedupe_survivors"](spark, SF))
    assert plan.count("RLIKE") <= 6
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(keys) == 1 and "_source_object" in keys[0] and "_chunk_index" in keys[0]


def test_latest_per_key_is_a_partial_aggregate(spark):
    plan = _plan(spark, QUERIES["latest_order_per_customer"](spark, SF))
    assert "partial_max" in plan and "Window" not in plan


def test_conditional_upsert_single_merge_join(spark):
    plan = _plan(spark, QUERIES["upsert_actions"](spark, SF))
    joins = len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan))
    assert joins == 1


def test_tasks_list_what_is_below_the_first_level(spark, landing):
    from ingestry.sources.landing import list_objects

    bodies = {"b/x.csv": "a\n", "y.txt": "b", "b/c/d/empty.csv": "", "e.csv": "", "_tmp/z.csv": "z", "b/.hidden/z.csv": "z", "b/_z.csv": "z"}
    files = list_objects(spark, landing(bodies))
    assert "FileScan" not in _plan(spark, files) and "MapInArrow" in _plan(spark, files)
    want = [("b/c/d/empty.csv", 0), ("b/x.csv", 2), ("e.csv", 0), ("y.txt", 1)]
    assert sorted((r.name, r.size) for r in files.collect()) == want
    stream_like = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing({}))
    from ingestry.sources.landing import described

    seen = {r.name: r.version for r in described(stream_like, landing({})).collect()}
    assert seen and all(seen[r.name] == r.version for r in files.collect() if r.name in seen)


def test_hours_of_an_alert_reach_the_scan(spark):
    plan = _plan(spark, QUERIES["alert_missed_api_runs"](spark, SF))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts", plan)
