"""Two consecutive batches through the daily job equal one direct computation."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martforge.operators import activity
from martforge.operators.timeslice import fan_out_zones
from martforge.plans import bindings as B
from martforge.plans import marts
from martforge.plans.daily import DexSources, run_dex_day
from martforge.plans.queries import ALL_END, ALL_START, landed_fills
from martforge.session import shared_dir
from martforge.sources.borrow import borrow_time
from martforge.sources.scans import land

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_two_batches_match_direct(spark):
    fills_src = B.fills(spark, SF)
    src = DexSources(
        closed=B.closed_orders(spark, SF), snapshot=B.order_rows(spark, SF), fills=fills_src,
        fees=borrow_time(B.fee_rows(spark, SF), fills_src), pairs=B.pairs(spark, SF), tokens=B.tokens(spark, SF),
        closed_spec=B.CLOSED_SPEC, snapshot_spec=B.SNAPSHOT_SPEC, fills_spec=B.FILLS_SPEC, fees_spec=B.FEES_SPEC,
    )
    root = shared_dir(spark, "daily")
    days = [dt.date(1996, 1, 1), dt.date(1996, 2, 1), dt.date(1996, 3, 1)]
    out = None
    for s, e in zip(days, days[1:]):
        out = run_dex_day(spark, src, s, e, root, dt.datetime.combine(e, dt.time(1)))
        rep = out["report"].collect()
        assert rep and all(r["passed"] for r in rep)
    published = spark.read.parquet(out["trade_d"])
    # KST 1996-01-01 also holds rows from UTC 1995-12-31 15:00+, which no batch landed
    keep = (F.col("bdate") > F.lit(days[0])) | (F.col("timezone_type") == "utc")
    direct = marts.trade_daily(
        marts.trade_details(landed_fills(spark, SF), B.pairs(spark, SF), B.tokens(spark, SF), ALL_START, ALL_END),
        days[0], days[-1],
    )
    cols = sorted(published.columns)
    a = sorted(tuple(r) for r in published.filter(keep).select(*cols).collect())
    b = sorted(tuple(r) for r in direct.filter(keep).select(*cols).collect())
    assert a and a == b
    # the order tables hold what one direct run over the landed rows gives
    closed = land(B.closed_orders(spark, SF), B.CLOSED_SPEC, days[0], days[-1])
    snapshot = land(B.order_rows(spark, SF), B.SNAPSHOT_SPEC, None, days[-1])
    details = marts.order_details(closed, snapshot, B.pairs(spark, SF), B.tokens(spark, SF), days[-1])
    act = activity.distinct_activity(fan_out_zones(details, None, days[-1]))
    for name, want in (("order_details", details), ("order_d", marts.order_daily(details, days[-1])), ("user_summary_d", activity.user_summary(act))):
        cols = sorted(want.columns)
        a, b = (sorted(map(str, df.select(*cols).collect())) for df in (spark.read.parquet(out[name]), want))
        assert a and a == b, name
    led = spark.read.parquet(f"{root}/etl_status")
    assert led.filter("status = 1").count() == led.count() and led.select("table_name").distinct().count() >= 10


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_bridge_batches_refresh_previous_day(spark):
    from martforge.plans.daily import BridgeSources, run_bridge_day
    from martforge.plans.queries import EV_END, EV_START, landed_prices, landed_transfers

    src = BridgeSources(
        history=B.transfers(spark, SF), prices=B.price_rows(spark, SF), stats=B.stat_rows(spark, SF),
        chains=B.chains(spark, SF), tokens=B.tokens(spark, SF),
        history_spec=B.TRANSFERS_SPEC, prices_spec=B.PRICES_SPEC, stats_spec=B.STATS_SPEC,
    )
    root = shared_dir(spark, "bridge_daily")
    cuts = [EV_START, dt.date(2024, 1, 16), EV_END]
    for s, e in zip(cuts, cuts[1:]):
        out = run_bridge_day(spark, src, s, e, root, dt.datetime.combine(e, dt.time(1)), stats_tie_cols=("ts_utc", "event_id"))
    published = spark.read.parquet(out["bridge_d"])
    tokens = B.tokens(spark, SF)
    price = marts.midnight_price(landed_prices(spark, SF), tokens, EV_START, EV_END)
    details = marts.bridge_details(landed_transfers(spark, SF), B.chains(spark, SF), tokens, EV_START, EV_END)
    direct = marts.bridge_daily(details, price, tokens, EV_START, EV_END)
    cols = sorted(published.columns)
    a = sorted(map(str, (tuple(r) for r in published.select(*cols).collect())))
    b = sorted(map(str, (tuple(r) for r in direct.select(*cols).collect())))
    assert a and a == b
    direct = marts.chain_stats_daily(land(B.stat_rows(spark, SF), B.STATS_SPEC, EV_START, EV_END), EV_START, EV_END, ("ts_utc", "event_id"))
    stats = spark.read.parquet(out["chain_stats_d"])
    cols = sorted(stats.columns)
    assert sorted(map(str, stats.select(*cols).collect())) == sorted(map(str, direct.select(*cols).collect()))
    assert stats.select("timezone_type", "bdate").distinct().count() == stats.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_a_bad_landing_stops_the_batch_before_the_marts(spark, monkeypatch):
    from martforge.plans import daily
    from martforge.plans.queries import EV_START
    from martforge.quality.checks import ReconciliationError

    root = shared_dir(spark, "bad_daily")
    whole = daily.land_table
    monkeypatch.setattr(daily, "land_table", lambda s, df, *a, **k: whole(s, df.filter("event_id % 2 = 0"), *a, **k))
    with pytest.raises(ReconciliationError):
        daily.run_stats_day(spark, B.stat_rows(spark, SF), B.STATS_SPEC, EV_START, EV_START + dt.timedelta(days=2), root, dt.datetime(2024, 1, 3))
    assert not os.path.exists(f"{root.removeprefix('file:')}/results/bridge/dw")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_the_windows_hold_all_rows(spark):
    from martforge.plans.queries import EV_END, EV_START

    created, events = B.orders_ts(B.table(spark, SF, "orders")), B.table(spark, SF, "events")
    for df, lo, hi in ((created, ALL_START, ALL_END), (events, EV_START, EV_END)):
        first, last = df.agg(F.min("ts"), F.max("ts")).first()
        assert lo <= first.date() and last.date() < hi
