"""Every registered query against its DuckDB oracle on the smallest driver tables,
plus the entry() smoke check."""

import os

import pytest

from oracle_compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"reason_code", "n"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_queries_match_oracle(spark):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    report = compare(spark, SF)
    bad = {k: v for k, v in report.items() if v.get("oracle") is not None or "error" in v or "match" in v}
    bad = {k: v for k, v in bad.items() if not v.get("match") and v.get("oracle", 1) is not None}
    assert not bad, bad
