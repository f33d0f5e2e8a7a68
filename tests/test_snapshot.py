import datetime as dt

from martforge.operators.snapshot import closest_to_midnight, closest_to_midnight_window
from martforge.operators.timeslice import fan_out_zones
from martforge.plans.marts import chain_stats_daily
from martforge.sources.scans import with_zone_columns

T = dt.datetime


def samples(spark):
    data = [
        (1, T(2024, 1, 2, 0, 10)),   # 10 after midnight of Jan 2
        (2, T(2024, 1, 1, 23, 45)),  # 15 before midnight, belongs to Jan 1
        (3, T(2024, 1, 3, 0, 3)),    # before 00:05 -> closes Jan 2
        (4, T(2024, 1, 2, 23, 59)),  # 1 before midnight of Jan 3, day Jan 2
        (5, T(2024, 1, 1, 15, 0)),   # KST midnight seen on the UTC clock
        (6, T(2024, 1, 1, 14, 59)),
        (7, T(2024, 1, 3, 12, 0)),
        (8, T(2024, 1, 3, 12, 0)),   # tie with 7, broken by id
    ]
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz")
    return with_zone_columns(df, "ts", "timestamp")


def test_aggregate_pick_equals_window(spark, rows_of):
    zoned = fan_out_zones(samples(spark), "2024-01-01", "2024-01-05")
    a = closest_to_midnight(zoned, ("ts_utc", "id"))
    b = closest_to_midnight_window(zoned, ("ts_utc", "id"))
    cols = ["timezone_type", "bdate", "id"]
    assert rows_of(a, *cols) == rows_of(b, *cols)


def test_pick_rules(spark):
    zoned = fan_out_zones(samples(spark), "2024-01-01", "2024-01-05")
    got = {(r["timezone_type"], r["bdate"]): r["id"] for r in closest_to_midnight(zoned, ("ts_utc", "id")).collect()}
    # 23:59 (1 minute) beats the next day's 00:03 (3 minutes), both close Jan 2
    assert got[("utc", dt.date(2024, 1, 2))] == 4
    assert got[("utc", dt.date(2024, 1, 1))] == 2
    assert got[("utc", dt.date(2024, 1, 3))] == 7


def test_chain_stats_clip_and_counters(spark):
    base = samples(spark)
    df = base.withColumn("total_blocks", base["id"] * 10)
    for c in ["total_transactions", "total_addresses", "total_gas_used", "transactions_today", "market_cap", "gas_used_today"]:
        df = df.withColumn(c, df["id"])
    out = chain_stats_daily(df, "2024-01-02", "2024-01-03", tie_cols=("ts_utc", "id"))
    rows = out.collect()
    assert {r["bdate"] for r in rows} == {dt.date(2024, 1, 2)}
    assert str(out.schema["total_blocks"].dataType) == "DecimalType(38,0)"
