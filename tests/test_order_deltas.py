"""Signed deltas of the order marts and owner bitmaps against a full recompute."""

import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martforge.operators import activity, bitmaps
from martforge.operators.deltas import NegativeCount, TotalSpec, live, moved_rows, next_state
from martforge.operators.timeslice import fan_out_zones
from martforge.plans import marts, order_deltas
from martforge.plans.daily import DexSources
from martforge.plans.order_deltas import order_daily_of_totals, run_order_delta
from martforge.session import shared_dir
from martforge.sinks import writes
from martforge.sources.scans import DatasetSpec, land

DAY = 86400
T0 = 19723 * DAY  # 2024-01-01
COLUMNS = (
    "idx long, pair_address string, order_id long, owner string, order_side int, price decimal(12,2), amount decimal(10,2), "
    "volume decimal(18,4), filled decimal(10,2), filled_volume decimal(18,4), price_usd_at decimal(12,2), volume_usd_at decimal(18,4), "
    "filled_usd_at decimal(18,4), created_at long, created_block long, created_hash string, closed_type int, closed_at long, "
    "closed_block long, closed_hash string"
)
CLOSED = DatasetSpec("dex", "close_orders", "closed_at")
LIVE = DatasetSpec("dex", "user_orders", "created_at")


def order(i, created, closed=None, owner="o1", pair="p1", price=1, closed_type=0):
    return (
        i, pair, i, owner, i % 2, price, 2, 3, 1, 1, price, 4, None if i % 3 == 0 else 5,
        T0 + int(created * DAY), i, "h", closed_type, None if closed is None else T0 + int(closed * DAY), i, "h",
    )


# created and closed in days from 2024-01-01; order 3 empties its owner's day 0 when it closes on day 2
ORDERS = [
    order(1, 0.1, 0.5), order(2, 0.2, 1.3, "o2"), order(3, 0.3, 2.4, "o3"), order(4, 0.9, None, "o4", closed_type=None), order(5, 1.7, 2.7, "o1", "p2"),
    order(6, 1.8, 1.9, None), order(7, 2.2, None, "o5", closed_type=1), order(8, 0.7, 2.1, "o8", price=None), order(9, 2.65, 2.66, "o9"),
    order(10, 0.4, 9.0, "o10"),
]


@pytest.fixture(scope="module")
def dims(spark):
    pairs = spark.createDataFrame([("p1", "P1", "q", "b"), ("p2", "P2", "q", "b")], "pair_address string, pair_name string, quote_address string, base_address string")
    tokens = spark.createDataFrame([("q", "Q", "QQ"), ("b", "B", "BB")], "address string, name string, symbol string")
    return pairs, tokens


def sources(spark, dims, rows):
    kinds = [c.split()[1] for c in COLUMNS.split(", ")]
    rows = [tuple(Decimal(v) if v is not None and k.startswith("decimal") else v for v, k in zip(r, kinds)) for r in rows]
    orders = spark.createDataFrame(rows, COLUMNS)
    return DexSources(
        closed=orders.filter("closed_at IS NOT NULL"), snapshot=orders, fills=None, fees=None, pairs=dims[0], tokens=dims[1],
        closed_spec=CLOSED, snapshot_spec=LIVE, fills_spec=None, fees_spec=None,
    )


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def batch(spark, src, n, root, bitmaps_too=False):
    return run_order_delta(spark, src, day(n), day(n + 1), root, dt.datetime.combine(day(n + 1), dt.time(1)), with_bitmaps=bitmaps_too)


def full(spark, src, end):
    closed = land(src.closed, CLOSED, dt.date(2000, 1, 1), end)
    snapshot = land(src.snapshot, LIVE, dt.date(2000, 1, 1), end)
    return marts.order_details(closed, snapshot, src.pairs, src.tokens, end)


def same(got, want):
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    a, b = (sorted(map(str, df.select(*cols).collect())) for df in (got, want))
    assert a and a == b


def test_batches_equal_a_full_recompute_each_day(spark, dims):
    src, root = sources(spark, dims, ORDERS), shared_dir(spark, "deltas")
    for n in range(4):
        out = batch(spark, src, n, root, True)
        details, end = full(spark, src, day(n + 1)), day(n + 1)
        totals = spark.read.parquet(out["order_totals"])
        same(order_daily_of_totals(totals, *dims, end), marts.order_daily(details, end))
        want = activity.user_summary(activity.distinct_activity(fan_out_zones(details, None, end)))
        same(bitmaps.metrics(spark.read.parquet(out["activity_bitmaps"]).filter(F.col("bdate") < F.lit(end))), want)
    ledger = spark.read.parquet(f"{root}/etl_status")
    assert ledger.filter("status = 0").isEmpty() and ledger.count() == 4 * 5


def test_a_batch_run_again_changes_nothing(spark, dims):
    src, root = sources(spark, dims, ORDERS), shared_dir(spark, "deltas")
    for n in (0, 1, 1, 2, 1, 2):
        out = batch(spark, src, n, root)
    same(order_daily_of_totals(spark.read.parquet(out["order_totals"]), *dims, day(3)), marts.order_daily(full(spark, src, day(3)), day(3)))


def test_a_batch_that_stopped_between_periods(spark, dims, monkeypatch):
    """Only some days were moved in when the run died; the next run does the rest, no day twice."""
    src, root = sources(spark, dims, ORDERS), shared_dir(spark, "deltas")
    batch(spark, src, 0, root)
    batch(spark, src, 1, root)
    whole = writes.replace_partitions

    def part(df, path, cols, fmt="parquet"):
        if path.endswith("order_totals"):
            whole(df.filter(F.col("period") == F.lit(day(0))), path, cols, fmt)
            raise OSError("lost")
        whole(df, path, cols, fmt)

    monkeypatch.setattr(writes, "replace_partitions", part)
    with pytest.raises(OSError):
        batch(spark, src, 2, root)
    monkeypatch.setattr(writes, "replace_partitions", whole)
    out = batch(spark, src, 2, root)
    assert day(0) not in out["periods"] and day(2) in out["periods"]
    same(order_daily_of_totals(spark.read.parquet(out["order_totals"]), *dims, day(3)), marts.order_daily(full(spark, src, day(3)), day(3)))


def test_only_touched_days_are_read_and_written(spark, dims):
    src, root = sources(spark, dims, ORDERS), shared_dir(spark, "deltas")
    for n in range(3):
        out = batch(spark, src, n, root, True)
    files = lambda p, d: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{p.removeprefix('file:')}/period={d}/*.parquet")}
    before = {(k, n): files(out[k], day(n)) for k in ("order_totals", "activity_bitmaps") for n in range(4)}
    late = batch(spark, src, 8, root, True)
    assert late["periods"] == []
    late = batch(spark, src, 9, root, True)  # order 10 closes: day 0 loses it, days 9 and 10 (KST) get it
    assert set(late["periods"]) == {day(0), day(9)}
    for (k, n), old in before.items():
        assert (files(late[k], day(n)) == old) == (n != 0), (k, n)
    closed = spark.read.parquet(late["close_orders"]).filter(F.col("period") == F.lit(day(9)))
    history = spark.read.parquet(late["user_orders"])
    earlier = order_deltas.open_rows_of(history, closed, closed, day(9), "day")
    plan = earlier._jdf.queryExecution().executedPlan().toString()
    partitions = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "period" in partitions and "2024-01-01" in partitions and "2024-01-02" not in partitions


def test_an_emptied_day_keeps_a_marker(spark, dims):
    src, root = sources(spark, dims, [order(1, 0.1, 3.2)]), shared_dir(spark, "deltas")
    for n in range(4):
        out = batch(spark, src, n, root, True)
    totals = spark.read.parquet(out["order_totals"])
    assert {(r["period"], r["n"]) for r in totals.filter(F.col("period") == F.lit(day(0))).collect()} == {(day(0), 0)}
    shown = order_daily_of_totals(totals, *dims, day(4))
    assert {r["bdate"] for r in shown.collect()} == {day(3)}
    assert {r["bdate"] for r in bitmaps.metrics(spark.read.parquet(out["activity_bitmaps"])).collect()} == {day(3)}


def test_orders_that_a_delta_cannot_follow_are_refused(spark, dims):
    with pytest.raises(order_deltas.OrderMoves):
        batch(spark, sources(spark, dims, [order(1, 1.5, 0.5)]), 0, shared_dir(spark, "deltas"))
    with pytest.raises(Exception, match="close_orders"):
        batch(spark, sources(spark, dims, [order(1, 0.1, 0.5), order(1, 0.1, 0.5)]), 0, shared_dir(spark, "deltas"))
    with pytest.raises(ValueError):
        run_order_delta(spark, sources(spark, dims, ORDERS), day(3), day(40), "x", dt.datetime(2024, 1, 4), "month")


SPEC = TotalSpec(("d", "k"), ("v",))


def test_totals_of_null_values_and_negative_counts(spark):
    rows = spark.createDataFrame([("1", "a", None, 1), ("1", "a", 2, 1), ("1", "b", None, 1), ("2", "a", 7, 1)], "d string, k string, v int, sign int")
    rows = rows.withColumn("v", F.col("v").cast("decimal(5,2)"))
    state = next_state(spark, SPEC, SPEC.signed(rows), None, "d", "b1")
    gone = rows.filter("v = 2 OR v = 7").withColumn("sign", F.lit(-1))
    new = next_state(spark, SPEC, SPEC.signed(gone), state, "d", "b2")
    out = {(r["d"], r["k"]): r["x"] for r in live(new).groupBy("d", "k").agg(SPEC.total("v").alias("x")).collect()}
    assert out == {("1", "a"): None, ("1", "b"): None}
    with pytest.raises(NegativeCount):
        next_state(spark, SPEC, SPEC.signed(gone), new, "d", "b3")
    assert next_state(spark, SPEC, SPEC.signed(gone), new, "d", "b2").isEmpty()


def test_moved_rows(spark):
    kind = "order_id long, pair_address string, x string"
    closed = spark.createDataFrame([(1, "p", "closed"), (2, "p", "closed")], kind)
    created = spark.createDataFrame([(2, "p", "open"), (3, "p", "open"), (2, "q", "open")], kind)
    earlier = spark.createDataFrame([(1, "p", "open"), (1, "q", "open"), (9, "p", "open")], kind)
    got = sorted(tuple(r) for r in moved_rows(closed, created, earlier, ["order_id", "pair_address"]).collect())
    assert got == [(1, "p", "closed", 1), (1, "p", "open", -1), (2, "p", "closed", 1), (2, "q", "open", 1), (3, "p", "open", 1)]


def test_owner_numbers_stay(spark):
    first = bitmaps.new_numbers(spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "owner string"), "owner", None)
    assert sorted(map(tuple, first.collect())) == [("a", 1), ("b", 2)]
    more = bitmaps.new_numbers(spark.createDataFrame([("b",), ("0",), ("c",)], "owner string"), "owner", first)
    assert sorted(map(tuple, more.collect())) == [("0", 3), ("c", 4)]


def test_bitmaps_over_several_buckets(spark):
    rows = spark.range(100_000).selectExpr(
        "'utc' AS timezone_type", "date_add(DATE'2024-01-28', cast(id % 9 AS int)) AS bdate", "'o' || (id % 70001) AS owner"
    )
    act = activity.distinct_activity(rows)
    numbers = bitmaps.new_numbers(act, "owner", None)
    maps = bitmaps.construct(act, numbers, ["timezone_type", "bdate"], "owner")
    assert maps.select("bucket").distinct().count() == 3
    same(bitmaps.metrics(maps), activity.user_summary(act))
