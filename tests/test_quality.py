import datetime as dt

import pytest

from martforge.quality import checks


def test_reconcile_with_tolerance(spark):
    r = spark.range
    tables = [
        checks.CountSources("svc", "equal", r(5), r(5), r(5)),
        checks.CountSources("svc", "tolerated", r(40), r(20), r(20), tolerance=30),
        checks.CountSources("svc", "broken", r(5), r(4), r(5)),
    ]
    out = {x["table_name"]: x for x in checks.reconcile_counts(tables).collect()}
    assert out["equal"]["passed"] and out["tolerated"]["passed"] and not out["broken"]["passed"]
    assert out["broken"]["report"] == "svc.broken FAIL DB: 5 S3: 4 Catalog: 5"
    with pytest.raises(checks.ReconciliationError):
        checks.assert_all_passed(checks.reconcile_counts(tables))


def test_max_timestamp_and_freshness(spark):
    a = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),), (dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    b = spark.createDataFrame([(dt.date(2024, 1, 2),)], "bdate date")
    out = checks.max_timestamp({"a": (a, "ts")}).first()
    assert out["max_ts"] == "2024-01-02 03:04:05"
    f = checks.freshness_equal(a, "ts", b, "bdate").first()
    assert f["is_equal"] and f["left_max"] == dt.date(2024, 1, 2)


def test_key_uniqueness(spark):
    df = spark.createDataFrame([("s", 1), ("s", 1), ("t", 1)], "symbol string, chain_id int")
    assert [r["symbol"] for r in checks.key_uniqueness(df, ["symbol", "chain_id"]).collect()] == ["s"]


def test_assert_unique(spark):
    df = spark.createDataFrame([("s", 1), ("s", 1), ("t", 1)], "symbol string, chain_id int")
    with pytest.raises(checks.ReconciliationError, match="occurs 2 times"):
        checks.assert_unique(df, ["symbol"], "token")
    checks.assert_unique(df.distinct(), ["symbol"], "token")


def test_latest_status_prefers_the_failure_and_the_last_attempt(spark):
    rows = [("s", "a", "t1", 1, 1), ("s", "a", "t1", 0, 1), ("s", "b", "t1", 0, 1), ("s", "b", "t1", 1, 2), ("s", "c", "t2", 0, 1), ("s", "c", "t1", 1, 3)]
    led = spark.createDataFrame(rows, "schema_name string, table_name string, batch_ts string, status int, attempt int")
    assert {r["table_name"]: r["status"] for r in checks.latest_status(led).collect()} == {"a": 0, "b": 1, "c": 0}
