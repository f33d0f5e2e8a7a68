"""Every mart query against its DuckDB oracle on the smallest test tables."""

import os

import pytest

SF = os.environ.get("MARTFORGE_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_all_queries_match_oracle(spark):
    import tools.parity as parity
    from martforge.plans.oracle import ORACLE_SQL
    from martforge.plans.queries import QUERIES

    assert set(ORACLE_SQL) == set(QUERIES)
    res = parity.compare(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E

    if not os.path.isdir(E.SMOKE_DIR):
        pytest.skip("smoke data not present")
    df = E.entry(spark)
    assert df.count() >= 0 and "tx_cnt" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
