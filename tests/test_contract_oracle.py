"""Every registered query of the library equals its DuckDB oracle (sf0.001 driver tables)."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_queries_match_oracle(spark):
    from eventide.plans.contract import NO_ORACLE, QUERIES
    res = compare(spark, SF, sorted(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "ok" and not (k in NO_ORACLE and v[0] == "rows-only")}
    assert not bad, bad
    assert set(QUERIES) - NO_ORACLE <= set(E.oracle_sql())
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "item_id", "view_count", "rank"]
    assert df.count() >= 0
