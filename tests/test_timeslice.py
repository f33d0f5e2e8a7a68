import datetime as dt

import pytest

from pyspark.sql import functions as F

from martforge.operators.timeslice import (
    fan_out_zones,
    filter_by_time,
    filter_by_time_end,
    filter_by_timezone,
    zones_by_union,
)
from martforge.sources.scans import DatasetSpec, land, slice_predicate, with_zone_columns

T = dt.datetime


def events(spark):
    # edge rows: KST day change at 15:00 UTC, slice bounds, midnight samples
    data = [
        (1, T(2024, 1, 1, 14, 59, 59)),
        (2, T(2024, 1, 1, 15, 0, 0)),
        (3, T(2024, 1, 2, 0, 0, 0)),
        (4, T(2024, 1, 2, 23, 59, 59)),
        (5, T(2024, 1, 3, 0, 0, 0)),
        (6, T(2023, 12, 31, 15, 30, 0)),
        (7, T(2024, 2, 29, 12, 0, 0)),
    ]
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz")
    return with_zone_columns(df, "ts", "timestamp")


def test_zone_columns(spark):
    out = {r["id"]: r for r in events(spark).collect()}
    assert out[1]["dt_utc"] == dt.date(2024, 1, 1) and out[1]["dt_kst"] == dt.date(2024, 1, 1)
    assert out[2]["dt_kst"] == dt.date(2024, 1, 2)
    assert out[2]["ts_kst"] == T(2024, 1, 2, 0, 0, 0)
    assert out[6]["dt_kst"] == dt.date(2024, 1, 1)


def test_epoch_columns_are_zone_independent(spark):
    from martforge.functions.scalars import ts_to_epoch

    # 2024-01-02 00:00, 2024-01-01 14:59:59, and inside the US DST gap 2024-03-10 02:30
    df = spark.createDataFrame([(1704153600,), (1704121199,), (1710037800,)], "t long")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        landed = with_zone_columns(df, "t", "epoch")
        out = sorted((r["ts_utc"], r["dt_kst"]) for r in landed.collect())
        back = sorted(r[0] for r in landed.select(ts_to_epoch("ts_utc")).collect())
        sliced = landed.filter(slice_predicate("ts_utc", "timestamp", "2024-01-02", "2024-03-11")).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out == [
        (T(2024, 1, 1, 14, 59, 59), dt.date(2024, 1, 1)),
        (T(2024, 1, 2, 0, 0, 0), dt.date(2024, 1, 2)),
        (T(2024, 3, 10, 2, 30, 0), dt.date(2024, 3, 10)),
    ]
    assert back == [1704121199, 1704153600, 1710037800]
    assert sliced == 2


def test_half_open_slice(spark):
    out = filter_by_time(events(spark), "2024-01-02", "2024-01-03")
    assert sorted(r["id"] for r in out.collect()) == [3, 4]
    until = filter_by_time_end(events(spark), "2024-01-02")
    assert sorted(r["id"] for r in until.collect()) == [1, 2, 6]


def test_slice_predicate_epoch_bounds(spark):
    df = spark.createDataFrame([(1704067199,), (1704067200,), (1704153599,), (1704153600,)], "t long")
    out = df.filter(slice_predicate("t", "epoch", "2024-01-01", "2024-01-02")).collect()
    assert sorted(r["t"] for r in out) == [1704067200, 1704153599]


def test_filter_by_timezone_renames(spark):
    out = filter_by_timezone(events(spark), "kst", "2024-01-02", "2024-01-03")
    assert "bdate" in out.columns and "dt_kst" not in out.columns and "dt_utc" not in out.columns
    assert sorted(r["id"] for r in out.collect()) == [2, 3]
    assert {r["timezone_type"] for r in out.collect()} == {"kst"}


def test_fan_out_equals_union(spark, rows_of):
    ev = events(spark)
    cols = ["id", "timezone_type", "bdate"]
    for start, end in [("2024-01-01", "2024-01-03"), ("2024-01-02", "2024-03-01"), (None, "2024-01-03")]:
        a = fan_out_zones(ev, start, end)
        b = zones_by_union(ev, start, end)
        assert rows_of(a, *cols) == rows_of(b, *cols)
        assert sorted(a.columns) == sorted(b.columns)


def test_land_modes(spark):
    df = spark.createDataFrame(
        [(1, 1704067200, 10), (2, 1704153600, 0), (3, 1703980800, 0)], "id long, t long, m int"
    ).withColumn("minute_marker", F.col("m"))
    sl = land(df, DatasetSpec("s", "x", "t"), "2024-01-01", "2024-01-03")
    assert sorted(r["id"] for r in sl.collect()) == [1, 2]
    snap = land(df, DatasetSpec("s", "x", "t", mode="overwrite"), "2024-01-01", "2024-01-02")
    assert sorted(r["id"] for r in snap.collect()) == [1, 3]
    pred = land(df, DatasetSpec("s", "x", "t", predicate="minute(ts_utc) = 0"), "2024-01-01", "2024-01-03")
    assert sorted(r["id"] for r in pred.collect()) == [1, 2]
    proj = land(df, DatasetSpec("s", "x", select=("id",)), None, "2024-01-01")
    assert proj.columns == ["id"] and proj.count() == 3


def test_default_slice():
    from martforge.operators.timeslice import default_slice

    assert default_slice("2024-03-01") == (dt.date(2024, 2, 29), dt.date(2024, 3, 1))


def test_jdbc_reader_is_always_partitioned():
    from martforge.sources.scans import jdbc_reader

    class Reader:
        def __init__(self):
            self.options = {}

        def format(self, name):
            assert name == "jdbc"
            return self

        def option(self, key, value):
            self.options[key] = value
            return self

    class Session:
        read = property(lambda self: Reader())

    # nothing is contacted until load(), so the options are all there is to check
    made = jdbc_reader(
        Session(), "jdbc:postgresql://db.invalid:5432/x", "(SELECT 1 AS id) t", "id", 0, 100, 4, user="u", driver="org.postgresql.Driver",
        options={"pushDownPredicate": "true"},
    ).options
    assert made == {
        "url": "jdbc:postgresql://db.invalid:5432/x", "dbtable": "(SELECT 1 AS id) t", "user": "u", "driver": "org.postgresql.Driver",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4", "fetchsize": "10000", "pushDownPredicate": "true",
    }
    with pytest.raises(ValueError):
        jdbc_reader(Session(), "u", "t", "id", None, 100, 4)
