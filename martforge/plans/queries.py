"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query runs over whole test tables; the only row selection is the
operator's own half-open time slice. Slices for the marts cover the whole
data range, slices for the scan operators are a real sub-range because the
slice *is* the operator.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.functions.scalars import hex_address, safe_cast, scale_units, usd_value, usd_value_double
from martforge.operators import activity, bitmaps
from martforge.operators.timeslice import default_slice, fan_out_zones
from martforge.plans import bindings as B
from martforge.plans import backfill, landing, marts, order_deltas
from martforge.plans.daily import Batch, DexSources, run_order_day, run_stats_day
from martforge.quality import checks, content
from martforge.session import shared_dir
from martforge.sinks import buckets, skipping, versions, writes
from martforge.sources import payloads
from martforge.sources.borrow import borrow_time
from martforge.sources.partitions import read_days, read_landed_for_zones
from martforge.sources.scans import OVERWRITE, DatasetSpec, land, slice_predicate, with_zone_columns

# --- fixed values: run parameters -------------------------------------------
EV_START, EV_END = _dt.date(2024, 1, 1), _dt.date(2024, 1, 31)        # events month
SLICE_START, SLICE_END = _dt.date(2024, 1, 8), _dt.date(2024, 1, 15)  # one week
ALL_START, ALL_END = _dt.date(1995, 1, 1), _dt.date(2001, 9, 1)        # all orders
ORDER_BUCKETS = 8
POINT_OWNER, POINT_PAIR = "0x11", "0x2a"
STREAM_CUT = _dt.date(2024, 1, 21)                                   # first arrival of the stream
SNAP_END = _dt.date(2001, 7, 31)                                      # a snapshot read a little early
SLICE_ARCHIVED = _dt.date(1995, 7, 1)                                # orders before it left the source
UNTIL_END = _dt.date(1998, 1, 1)                                     # snapshot bound
ORDER_CUTS = (ALL_START, _dt.date(1996, 7, 1), _dt.date(1998, 1, 1), ALL_END)  # order batches
RUN1_START, RUN1_END = _dt.date(2024, 1, 1), _dt.date(2024, 1, 20)  # sink reruns
RUN2_START, RUN2_END = _dt.date(2024, 1, 10), _dt.date(2024, 1, 31)
LOAD_TS = _dt.datetime(2024, 2, 1, 3, 0, 0)                           # stats load stamp
BATCH_TS = _dt.datetime(2024, 2, 1, 4, 0, 0)                          # ledger batch time
DIGITS = "35791246809135792468013579246801357924680"                      # filler of wide test numbers
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


# --- landed inputs ---------------------------------------------------------------
def _events(spark, sf_dir):
    return B.table(spark, sf_dir, "events")


def landed_events(spark, sf_dir, start=EV_START, end=EV_END) -> DataFrame:
    spec = DatasetSpec("events", "events", "ts", time_kind="timestamp", select=("event_id", "user_id", "event_type", "value", "ts"))
    return land(_events(spark, sf_dir), spec, start, end)


def landed_closed(spark, sf_dir):
    return land(B.closed_orders(spark, sf_dir), B.CLOSED_SPEC, ALL_START, ALL_END)


def landed_snapshot(spark, sf_dir, end=ALL_END):
    return land(B.order_rows(spark, sf_dir), B.SNAPSHOT_SPEC, None, end)


def landed_fills(spark, sf_dir):
    return land(B.fills(spark, sf_dir), B.FILLS_SPEC, ALL_START, ALL_END)


def landed_fees(spark, sf_dir, start=ALL_START, end=ALL_END):
    borrowed = borrow_time(B.fee_rows(spark, sf_dir), B.fills(spark, sf_dir), "block", "time_utc")
    return land(borrowed, B.FEES_SPEC, start, end)


def landed_transfers(spark, sf_dir):
    return land(B.transfers(spark, sf_dir), B.TRANSFERS_SPEC, EV_START, EV_END)


def landed_prices(spark, sf_dir):
    return land(B.price_rows(spark, sf_dir), B.PRICES_SPEC, EV_START, EV_END)


def landed_stats(spark, sf_dir):
    return land(B.stat_rows(spark, sf_dir), B.STATS_SPEC, EV_START, EV_END)


def order_details_df(spark, sf_dir):
    return marts.order_details(
        landed_closed(spark, sf_dir), landed_snapshot(spark, sf_dir), B.pairs(spark, sf_dir), B.tokens(spark, sf_dir), ALL_END
    )


def trade_details_df(spark, sf_dir):
    return marts.trade_details(landed_fills(spark, sf_dir), B.pairs(spark, sf_dir), B.tokens(spark, sf_dir), ALL_START, ALL_END)


def midnight_price_df(spark, sf_dir):
    return marts.midnight_price(landed_prices(spark, sf_dir), B.tokens(spark, sf_dir), EV_START, EV_END)


def bridge_details_df(spark, sf_dir):
    return marts.bridge_details(
        landed_transfers(spark, sf_dir), B.chains(spark, sf_dir), B.tokens(spark, sf_dir), EV_START, EV_END
    )


def activity_df(spark, sf_dir):
    zoned = fan_out_zones(order_details_df(spark, sf_dir), None, ALL_END)
    return activity.distinct_activity(zoned)


# --- sources -----------------------------------------------------------------
def q_scan_time_slice(spark, sf_dir):
    return landed_events(spark, sf_dir, SLICE_START, SLICE_END)


def q_scan_until(spark, sf_dir):
    return landed_snapshot(spark, sf_dir, UNTIL_END)


def q_scan_projection(spark, sf_dir):
    return B.pairs(spark, sf_dir)


def q_scan_extra_predicate(spark, sf_dir):
    return landed_prices(spark, sf_dir)


def q_scan_borrow_timestamp(spark, sf_dir):
    return landed_fees(spark, sf_dir)


def q_scan_partition_list(spark, sf_dir):
    path = shared_dir(spark, "landing", "dl_events")
    writes.replace_partitions(landed_events(spark, sf_dir), path, ["dt_utc"])
    return read_days(spark, path, SLICE_START, SLICE_END)


def q_hex_normalise(spark, sf_dir):
    s = B.table(spark, sf_dir, "supplier")
    return s.select(
        "s_suppkey",
        hex_address("s_suppkey").alias("suppkey_hex"),
        hex_address(F.col("s_name").cast("binary")).alias("name_hex"),
        F.lower(F.concat(F.lit("0xAbC"), F.hex("s_suppkey"))).alias("hash_lower"),
    )


def q_dual_zone_columns(spark, sf_dir):
    return with_zone_columns(_events(spark, sf_dir).select("event_id", "ts"), "ts", "timestamp")


def q_dual_zone_rows(spark, sf_dir):
    landed = with_zone_columns(_events(spark, sf_dir).select("event_id", "user_id", "value", "ts"), "ts", "timestamp")
    return fan_out_zones(landed, EV_START, EV_END).select(
        "event_id", "user_id", "timezone_type", "bdate", "ts_utc", "ts_kst", "value"
    )


# --- JSON ingest -------------------------------------------------------------
def token_pages(spark, sf_dir) -> DataFrame:
    """One API page per event with a well-formed and a malformed token item."""
    e = _events(spark, sf_dir)
    good = F.struct(
        hex_address("event_id").alias("address"),
        F.col("value").cast("string").alias("circulating_market_cap"),
        (F.col("user_id") % 19).cast("string").alias("decimals"),
        F.col("value").cast("string").alias("exchange_rate"),
        F.col("user_id").cast("string").alias("holders"),
        F.concat(F.lit("icon-"), F.col("event_id").cast("string")).alias("icon_url"),
        F.col("event_type").alias("name"),
        F.upper("event_type").alias("symbol"),
        (F.col("event_id") * 1000).cast("string").alias("total_supply"),
        F.lit("ERC-20").alias("type"),
        F.col("value").cast("string").alias("volume_24h"),
    )
    bad = F.struct(
        hex_address(F.col("event_id") + 1000000000).alias("address"),
        F.lit("n/a").alias("circulating_market_cap"),
        F.col("event_type").alias("decimals"),
        F.lit("").alias("exchange_rate"),
        F.col("event_id").cast("string").alias("holders"),
        F.lit(None).cast("string").alias("icon_url"),
        F.lit("junk").alias("name"),
        F.lit(None).cast("string").alias("symbol"),
        F.lit("abc").alias("total_supply"),
        F.lit("ERC-721").alias("type"),
        F.lit(None).cast("string").alias("volume_24h"),
    )
    return e.select("event_id", F.to_json(F.struct(F.array(good, bad).alias("items"))).alias("payload"))


def q_json_items_explode(spark, sf_dir):
    return payloads.token_items(token_pages(spark, sf_dir), keep=("event_id",))


def stats_payloads(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir)
    obj = F.struct(
        F.col("value").alias("average_block_time"),
        F.col("value").alias("coin_price"),
        (F.col("user_id") - 50).alias("coin_price_change_percentage"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("gas_price_updated_at"),
        F.struct(
            F.col("user_id").alias("slow"), (F.col("user_id") * 2).alias("average"), (F.col("user_id") * 3).alias("fast")
        ).alias("gas_prices"),
        F.col("event_id").alias("gas_prices_update_in"),
        (F.col("user_id") * 21000).alias("gas_used_today"),
        (F.col("event_id") + 1000000).alias("market_cap"),
        F.col("value").alias("network_utilization_percentage"),
        F.lit("img").alias("coin_image"),
        F.lit("img2").alias("secondary_coin_image"),
        F.col("event_type").alias("static_gas_price"),
        F.col("user_id").alias("total_addresses"),
        (F.col("event_id") * 10).alias("total_blocks"),
        (F.col("event_id") * 21000).alias("total_gas_used"),
        (F.col("event_id") * 100 + F.col("user_id")).alias("total_transactions"),
        F.col("user_id").alias("transactions_today"),
        F.col("event_id").alias("tvl"),
    )
    return e.select("event_id", F.to_json(obj).alias("payload"))


def q_json_flatten(spark, sf_dir):
    return payloads.chain_stats(stats_payloads(spark, sf_dir), LOAD_TS, keep=("event_id",))


def q_json_contracts(spark, sf_dir):
    return payloads.contracts(contract_pages(spark, sf_dir), keep=("s_suppkey",))


def q_safe_numeric_casts(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(
        "event_id",
        safe_cast(payloads.json_field("props", "$.k"), "int").alias("k_int"),
        safe_cast("event_type", "int").alias("type_int"),
        safe_cast(F.col("value").cast("string"), "decimal(38,2)").alias("value_dec"),
        safe_cast(F.concat(F.col("user_id").cast("string"), F.lit("x")), "int").alias("junk_int"),
        safe_cast((F.col("event_id") * 1000).cast("string"), "decimal(38,0)").alias("supply_dec"),
    )


# --- marts ---------------------------------------------------------------------
def q_order_details(spark, sf_dir):
    return order_details_df(spark, sf_dir)


def q_order_details_bucketed(spark, sf_dir):
    """D2 from landings bucketed by the keys of its joins: no shuffle before the anti join."""
    root = shared_dir(spark, "buckets")
    tag = "mf_b_" + root.rsplit("/", 1)[-1]
    keys, n = ["order_id", "pair_address"], ORDER_BUCKETS
    closed = buckets.write_bucketed(landed_closed(spark, sf_dir), f"{tag}_closed", f"{root}/closed", keys, n)
    snapshot = buckets.write_bucketed(landed_snapshot(spark, sf_dir), f"{tag}_snapshot", f"{root}/snapshot", keys, n)
    pairs = buckets.write_bucketed(B.pairs(spark, sf_dir), f"{tag}_pairs", f"{root}/pairs", ["pair_address"], n)
    return marts.order_details(closed, snapshot, pairs, B.tokens(spark, sf_dir), ALL_END)


def q_order_daily(spark, sf_dir):
    return marts.order_daily(order_details_df(spark, sf_dir), ALL_END)


def q_trade_details(spark, sf_dir):
    return trade_details_df(spark, sf_dir)


def q_trade_daily(spark, sf_dir):
    return marts.trade_daily(trade_details_df(spark, sf_dir), ALL_START, ALL_END)


def q_fee_daily(spark, sf_dir):
    return marts.fee_daily(landed_fees(spark, sf_dir), B.pairs(spark, sf_dir), B.tokens(spark, sf_dir), ALL_START, ALL_END)


def q_order_matches_daily(spark, sf_dir):
    return marts.order_matches_daily(landed_fills(spark, sf_dir), B.pairs(spark, sf_dir), B.tokens(spark, sf_dir), ALL_START, ALL_END)


def q_open_order_tvl(spark, sf_dir):
    return marts.open_order_tvl(order_details_df(spark, sf_dir), ALL_END)


def q_trade_daily_with_tvl(spark, sf_dir):
    """D16 tail: taker-trade mart with open-order value attached, NULL -> 0."""
    trades = marts.trade_daily(trade_details_df(spark, sf_dir), ALL_START, ALL_END)
    return marts.trade_daily_with_tvl(trades, marts.open_order_tvl(order_details_df(spark, sf_dir), ALL_END))


def q_trade_daily_with_open_only(spark, sf_dir):
    """D16 tail with the keys that have open orders and no trade."""
    trades = marts.trade_daily(trade_details_df(spark, sf_dir), ALL_START, ALL_END)
    return marts.trade_daily_with_tvl(trades, marts.open_order_tvl(order_details_df(spark, sf_dir), ALL_END), open_only=True)


def scaling_rows(spark, sf_dir) -> DataFrame:
    """Per event: a value of 1 to 38 digits, a price of 2 to 18 digits and 0 to 30 decimals."""
    e = _events(spark, sf_dir)
    value = F.substring(F.concat((F.col("event_id") * 7919 + 13).cast("string"), F.lit(DIGITS)), F.lit(1), F.col("event_id") % 38 + 1)
    price = F.substring(F.concat((F.col("user_id") * 31 + 11).cast("string"), F.lit(DIGITS)), F.lit(1), F.col("event_id") % 17 + 2)
    return e.select(
        "event_id",
        value.cast("decimal(38,0)").alias("value"),
        F.concat(price, F.lit("E-"), (F.col("event_id") % 19).cast("string")).cast("decimal(38,18)").alias("price"),
        (F.col("event_id") % 31).cast("int").alias("decimals"),
    )


def q_token_scaling(spark, sf_dir):
    """F10 / F11 over wide ranges: exact decimals, and a number for every row."""
    tokens, usd = scale_units("value", "decimals"), usd_value("value", "price", "decimals")
    return scaling_rows(spark, sf_dir).select(
        "event_id",
        tokens.alias("tokens"),
        usd.alias("usd"),
        (tokens.isNull() | usd.isNull()).alias("wide"),
        F.coalesce(usd.cast("double"), usd_value_double("value", "price", "decimals")).isNotNull().alias("has_usd"),
    )


def q_bridge_details(spark, sf_dir):
    return bridge_details_df(spark, sf_dir)


def q_bridge_daily(spark, sf_dir):
    return marts.bridge_daily(
        bridge_details_df(spark, sf_dir), midnight_price_df(spark, sf_dir), B.tokens(spark, sf_dir), EV_START, EV_END
    )


def q_midnight_price(spark, sf_dir):
    return midnight_price_df(spark, sf_dir)


def q_closest_to_midnight(spark, sf_dir):
    return marts.chain_stats_daily(landed_stats(spark, sf_dir), EV_START, EV_END, tie_cols=("ts_utc", "event_id"))


def q_dau(spark, sf_dir):
    return activity.daily_active(activity_df(spark, sf_dir))


def q_wau(spark, sf_dir):
    return activity.weekly_active(activity_df(spark, sf_dir))


def q_mau(spark, sf_dir):
    return activity.monthly_active(activity_df(spark, sf_dir))


def q_cumulative_users(spark, sf_dir):
    return activity.cumulative_users(activity_df(spark, sf_dir))


def q_new_users(spark, sf_dir):
    return activity.new_users(activity_df(spark, sf_dir))


def q_user_summary(spark, sf_dir):
    return activity.user_summary(activity_df(spark, sf_dir))


# --- batches ---------------------------------------------------------------------
def dex_sources(spark, sf_dir) -> DexSources:
    """Sources of the order batches; both order tables are landed up to the end of the batch, in one
    folder (a folder per day over seven years of sparse test orders would only time the file system)."""
    fills = B.fills(spark, sf_dir)
    return DexSources(
        closed=B.closed_orders(spark, sf_dir), snapshot=B.order_rows(spark, sf_dir), fills=fills,
        fees=borrow_time(B.fee_rows(spark, sf_dir), fills, "block", "time_utc"), pairs=B.pairs(spark, sf_dir), tokens=B.tokens(spark, sf_dir),
        closed_spec=replace(B.CLOSED_SPEC, mode=OVERWRITE, partition_cols=()), snapshot_spec=replace(B.SNAPSHOT_SPEC, partition_cols=()),
        fills_spec=B.FILLS_SPEC, fees_spec=B.FEES_SPEC,
    )


def _order_batches(spark, sf_dir, table):
    """Three batches over all orders; orders close up to 60 days late, so days empty between batches."""
    root, out = shared_dir(spark, "orders"), {}
    for start, end in zip(ORDER_CUTS, ORDER_CUTS[1:]):
        stamp = _dt.datetime.combine(end, _dt.time(1))
        out = run_order_day(spark, dex_sources(spark, sf_dir), start, end, root, stamp, partitioned=False, last=table)
    return spark.read.parquet(out[table])


def q_order_details_batched(spark, sf_dir):
    return _order_batches(spark, sf_dir, "order_details")


def q_order_daily_batched(spark, sf_dir):
    return _order_batches(spark, sf_dir, "order_d")


def q_user_summary_batched(spark, sf_dir):
    return _order_batches(spark, sf_dir, "user_summary_d")


def _order_deltas(spark, sf_dir, with_bitmaps=False):
    """The same three batches as signed deltas, by monthly partitions (seven years of sparse test orders)."""
    root, out = shared_dir(spark, "order_deltas"), {}
    for start, end in zip(ORDER_CUTS, ORDER_CUTS[1:]):
        stamp = _dt.datetime.combine(end, _dt.time(1))
        out = order_deltas.run_order_delta(spark, dex_sources(spark, sf_dir), start, end, root, stamp, order_deltas.MONTHS, with_bitmaps)
    return out


def q_order_daily_delta(spark, sf_dir):
    """D3 by signed deltas: a batch reads and rewrites only what its orders moved."""
    totals = spark.read.parquet(_order_deltas(spark, sf_dir)["order_totals"])
    return order_deltas.order_daily_of_totals(totals, B.pairs(spark, sf_dir), B.tokens(spark, sf_dir), ALL_END)


def q_activity_bitmaps(spark, sf_dir):
    """D7 from bitmaps of owner numbers that three batches kept up to date."""
    maps = spark.read.parquet(_order_deltas(spark, sf_dir, True)["activity_bitmaps"])
    return bitmaps.metrics(maps.filter(F.col("bdate") < F.lit(ALL_END)))


def q_chain_stats_batched(spark, sf_dir):
    """D10 in one batch per day over all events."""
    root, day, out = shared_dir(spark, "stats"), EV_START, {}
    while day < EV_END:
        after = day + _dt.timedelta(days=1)
        stamp = _dt.datetime.combine(after, _dt.time(1))
        out = run_stats_day(spark, B.stat_rows(spark, sf_dir), B.STATS_SPEC, day, after, root, stamp, ("ts_utc", "event_id"))
        day = after
    return spark.read.parquet(out["chain_stats_d"])


def q_chain_stats_backfill(spark, sf_dir):
    """D10 of a month in which every batch was missed: one landing, one mart job, a ledger row per day."""
    root = shared_dir(spark, "backfill")
    days = backfill.missed_days(None, "bridge", "chain_stats_d", EV_START, EV_END)
    stamp = lambda day: _dt.datetime.combine(day + _dt.timedelta(days=1), _dt.time(1))
    out = backfill.run_stats_backfill(spark, B.stat_rows(spark, sf_dir), B.STATS_SPEC, days, root, stamp, ("ts_utc", "event_id"))
    return spark.read.parquet(out["chain_stats_d"])


# --- API landings -----------------------------------------------------------------
def _landed(spark, name, load):
    """Land twice (a second load replaces or appends) and read through the catalog."""
    root = shared_dir(spark, "api")
    table = f"mf_{name}_" + root.rsplit("/", 1)[-1]
    for hours in (0, 24):
        load(root, f"{root}/etl_status", LOAD_TS + _dt.timedelta(hours=hours), table)
    return spark.table(table)


def q_landing_token(spark, sf_dir):
    pages = token_pages(spark, sf_dir).select("payload")
    return _landed(spark, "token", lambda r, led, ts, t: landing.land_token_list(spark, pages, r, led, ts, "wallet", "token", t, layer="dim"))


def q_landing_stats(spark, sf_dir):
    polls = stats_payloads(spark, sf_dir).select("payload")
    rows = _landed(spark, "stats", lambda r, led, ts, t: landing.land_chain_stats(spark, polls, ts, r, led, t))
    return rows.select("dt_utc", "ts_utc", "dt_kst", "ts_kst", "total_blocks", "total_transactions", "gas_prices_fast", "tvl")


def contract_pages(spark, sf_dir) -> DataFrame:
    s = B.table(spark, sf_dir, "supplier")
    item = F.struct(
        F.struct(F.concat(F.lit("0xAbC"), F.hex("s_suppkey")).alias("hash"), F.col("s_name").alias("name")).alias("address"),
        F.concat(F.lit("2024-01-"), F.lpad(((F.col("s_suppkey") % 28) + 1).cast("string"), 2, "0")).alias("verified_at"),
    )
    return s.select("s_suppkey", F.to_json(F.struct(F.array(item).alias("items"))).alias("payload"))


def q_landing_contracts(spark, sf_dir):
    pages = contract_pages(spark, sf_dir).select("payload")
    return _landed(spark, "contract", lambda r, led, ts, t: landing.land_contracts(spark, pages, r, led, ts, t))


def q_json_bad_pages(spark, sf_dir):
    """Pages cut short, without items and with empty items are found; good ones are not."""
    kind = F.col("event_id") % 5
    good = F.col("payload")
    pages = token_pages(spark, sf_dir).select(
        "event_id",
        F.when(kind == 0, F.substring(good, F.lit(1), (F.length(good) - 1).cast("int")))
        .when(kind == 1, F.lit('{"other": 1}'))
        .when(kind == 2, F.lit('{"items": []}'))
        .when(kind == 3, F.lit(None).cast("string"))
        .otherwise(good)
        .alias("payload"),
    )
    return payloads.bad_pages(pages, keep=("event_id",))


# --- sinks ---------------------------------------------------------------------
def event_daily(spark, sf_dir, start, end, drop_errors=False) -> DataFrame:
    """A small daily mart used to exercise the writers."""
    zoned = fan_out_zones(landed_events(spark, sf_dir, EV_START, EV_END), start, end)
    if drop_errors:
        zoned = zoned.filter(F.col("event_type") != "error")
    return zoned.groupBy("timezone_type", "bdate", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(38,10)").alias("value"),
    )


def q_daily_from_landed(spark, sf_dir):
    """E2 shape: landed dl table (by dt_utc) -> dual-zone daily mart for one week,
    reading only the day partitions the slice needs."""
    path = shared_dir(spark, "landing", "dl_events")
    writes.replace_partitions(landed_events(spark, sf_dir), path, ["dt_utc"])
    landed = read_landed_for_zones(spark, path, SLICE_START, SLICE_END)
    zoned = fan_out_zones(landed, SLICE_START, SLICE_END, partition_col="dt_utc")
    return zoned.groupBy("timezone_type", "bdate", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(38,10)").alias("value"),
    )


def _runs(spark, sf_dir):
    return (
        event_daily(spark, sf_dir, RUN1_START, RUN1_END),
        event_daily(spark, sf_dir, RUN2_START, RUN2_END, drop_errors=True),
    )


def q_partition_replace(spark, sf_dir):
    path = shared_dir(spark, "sinks", "dm_event_d")
    first, second = _runs(spark, sf_dir)
    writes.replace_partitions(first, path, ["bdate"])
    writes.replace_partitions(second, path, ["bdate"])
    return spark.read.parquet(path)


def q_partitioned_overwrite(spark, sf_dir):
    path = shared_dir(spark, "sinks", "dm_event_d")
    first, second = _runs(spark, sf_dir)
    writes.replace_table(first, path, ["bdate"])
    writes.replace_table(second, path, ["bdate"])
    return spark.read.parquet(path)


def q_unpartitioned_replace(spark, sf_dir):
    path = shared_dir(spark, "sinks", "dm_event_total")
    first, second = _runs(spark, sf_dir)
    writes.replace_partitions(first, path, [])
    writes.replace_partitions(second, path, [])
    return spark.read.parquet(path)


def _by_version(spark, sf_dir, table, cols):
    """Two publishes by location switch; a reader in between sees the first whole, then the second."""
    path = shared_dir(spark, "sinks", table)
    name = "mf_v_" + path.rsplit("/", 1)[-1]
    for run in _runs(spark, sf_dir):
        versions.publish_version(run, name, path, cols)
    return spark.table(name)


def q_table_by_version(spark, sf_dir):
    return _by_version(spark, sf_dir, "dm_event_total", [])


def q_partitioned_by_version(spark, sf_dir):
    return _by_version(spark, sf_dir, "dm_event_d", ["bdate"])


def q_emptied_days(spark, sf_dir):
    """K1 for a slice: a second run of the month finds nothing on some days (by their last event), which it empties.

    Returned are the catalog's rows per day, with the emptied days that the ledger names.
    """
    root = shared_dir(spark, "emptied")
    name = "mf_" + root.rsplit("/", 1)[-1]
    events = land(_events(spark, sf_dir), DatasetSpec("events", "events", "ts", time_kind="timestamp"), EV_START, EV_END)
    busy = events.groupBy("dt_utc").agg(F.max("event_id").alias("last")).filter("last % 3 != 0").select("dt_utc")
    for hours, rows in ((0, events), (1, events.join(busy, "dt_utc", "left_semi"))):
        job = writes.JobInfo("events", "dl", "events", EV_START, EV_END, BATCH_TS + _dt.timedelta(hours=hours))
        daily = rows.groupBy("dt_utc").agg(F.count("*").alias("events"))
        writes.publish(spark, daily, job, root, f"{root}/etl_status", ["dt_utc"], name, drop_empty=True)
    named = spark.read.parquet(f"{root}/etl_status").filter("emptied_days IS NOT NULL")
    gone = named.select(F.explode(F.split("emptied_days", ",").cast("array<date>")).alias("dt_utc"), F.lit(0).cast("long").alias("events"))
    return spark.table(name).select("dt_utc", "events").unionByName(gone)


def q_skip_empty(spark, sf_dir):
    """A slice without rows is not published, so the table and the ledger stay as the first run left them."""
    root = shared_dir(spark, "skip_empty")
    first, _ = _runs(spark, sf_dir)
    for hours, rows in ((0, first), (1, event_daily(spark, sf_dir, EV_END + _dt.timedelta(days=2), EV_END + _dt.timedelta(days=30)))):
        job = writes.JobInfo("events", "dm", "event_d", RUN1_START, RUN1_END, BATCH_TS + _dt.timedelta(hours=hours))
        writes.publish(spark, rows, job, root, f"{root}/etl_status", skip_empty=True, drop_empty=True)
    rows = spark.read.parquet(writes.table_path(root, "events", "dm", "event_d"))
    publishes = spark.read.parquet(f"{root}/etl_status").filter("status = 1").groupBy("table_name").agg(F.count("*").alias("publishes"))
    return rows.withColumn("table_name", F.lit("event_d")).join(publishes, "table_name").drop("table_name")


def q_default_slice(spark, sf_dir):
    """The events of the batch of a given day, ``[day - 1, day)``."""
    start, end = default_slice(SLICE_END)
    return land(_events(spark, sf_dir), DatasetSpec("events", "events", "ts", time_kind="timestamp", select=("event_id", "ts")), start, end)


def q_point_scan(spark, sf_dir):
    """S4 on a table laid out by (owner, pair, time): one owner's orders and one pair's, from few row groups."""
    path = shared_dir(spark, "skipping")
    orders = land(B.order_rows(spark, sf_dir), replace(B.SNAPSHOT_SPEC, mode="append"), ALL_START, ALL_END)
    skipping.write_clustered(orders, path, ["owner", "pair_address", "created_at"], 8, bloom=["created_hash"], row_group_bytes=1 << 16)
    table = spark.read.parquet(path)
    pair = (F.col("pair_address") == POINT_PAIR) & slice_predicate("created_at", "epoch", UNTIL_END, ALL_END)
    return table.filter((F.col("owner") == POINT_OWNER) | pair).select("order_id", "owner", "pair_address", "created_at", "amount")


def q_append_only(spark, sf_dir):
    path = shared_dir(spark, "sinks", "dm_event_d")
    first, second = _runs(spark, sf_dir)
    writes.append_rows(first, path, "event_d")
    writes.append_rows(second, path, "event_d")
    return spark.read.parquet(path)


def q_publish_guarded(spark, sf_dir):
    root = shared_dir(spark, "publish")
    name = "mf_" + root.rsplit("/", 1)[-1]
    job = writes.JobInfo("events", "dm", "event_d", RUN1_START, RUN2_END, BATCH_TS)
    first, second = _runs(spark, sf_dir)
    writes.publish(spark, first, job, root, f"{root}/etl_status", catalog_name=name)
    writes.publish(spark, second, job, root, f"{root}/etl_status", catalog_name=name)
    return spark.table(name)


def q_landing_publish(spark, sf_dir):
    """Land the bridge-history source for its whole range and publish it."""
    from martforge.plans.landing import land_table

    root = shared_dir(spark, "landing")
    name = "mf_dl_history_" + root.rsplit("/", 1)[-1]
    land_table(spark, B.transfers(spark, sf_dir), B.TRANSFERS_SPEC, EV_START, EV_END, root, f"{root}/etl_status", BATCH_TS, name)
    return spark.table(name)


def q_stream_landing(spark, sf_dir):
    """Incremental landing of the events file as an availableNow stream."""
    from martforge.streaming.incremental import land_available

    root = shared_dir(spark, "stream")
    schema = _events(spark, sf_dir).schema
    spec = DatasetSpec("events", "events", "ts", time_kind="timestamp", select=("event_id", "user_id", "event_type", "value", "ts"))
    for _ in range(2):  # the rerun finds no new file and adds nothing
        land_available(spark, sf_dir, schema, spec, f"{root}/dl_events", f"{root}/_checkpoint", file_glob="events.parquet")
    return spark.read.parquet(f"{root}/dl_events")


def q_content_reconciliation(spark, sf_dir):
    """Keys by which a landing of the live orders differs from the source, by (month, bucket) checksums.

    The landing holds the orders created before UNTIL_END, as they were then: orders closed later
    were not filled yet. The source has since lost the orders created before SLICE_ARCHIVED.
    """
    kept = replace(B.SNAPSHOT_SPEC, mode="append")
    live = B.order_rows(spark, sf_dir)
    then = F.when(slice_predicate("closed_at", "epoch", None, UNTIL_END), F.col("filled")).otherwise(F.lit(0).cast("decimal(10,2)"))
    source, landed = (
        land(df, kept, start, end).withColumn("month", F.trunc("dt_utc", "month"))
        for df, start, end in ((live, SLICE_ARCHIVED, ALL_END), (live.withColumn("filled", then), ALL_START, UNTIL_END))
    )
    return content.key_differences(source, landed, "month", ["order_id", "pair_address"], ["owner", "price", "amount", "filled"])


def transfer_versions(spark, sf_dir) -> list[DataFrame]:
    """Two arrivals of the transfers: those before STREAM_CUT, some not final yet, then the rest and the late updates."""
    rows = B.transfers(spark, sf_dir)
    early = slice_predicate("initiated_time", "epoch", EV_START, STREAM_CUT)
    late = F.col("_id") % 7 == 0
    nothing = {c: F.lit(None).cast(rows.schema[c].dataType) for c in ("finalized_tx_hash", "finalized_time")}
    first = rows.filter(early).select(
        *[F.when(late, v).otherwise(F.col(c)).alias(c) if (v := nothing.get(c, F.lit(0).cast("int") if c == "status" else None)) is not None else F.col(c) for c in rows.columns],
        F.lit(1).alias("version"),
    )
    in_month = slice_predicate("initiated_time", "epoch", EV_START, EV_END)
    return [first, rows.filter(in_month & (~early | late)).withColumn("version", F.lit(2))]


def q_bridge_stream(spark, sf_dir):
    """D9 kept up to date by a stream over two file arrivals, the second after a restart."""
    from martforge.streaming.bridge import run_bridge_stream

    root = shared_dir(spark, "bridge_stream")
    tokens, chains = B.tokens(spark, sf_dir), B.chains(spark, sf_dir)
    prices = marts.midnight_price(landed_prices(spark, sf_dir), tokens, EV_START, EV_END)
    for arrival in transfer_versions(spark, sf_dir):
        arrival.write.mode("append").parquet(f"{root}/arrivals")
        run_bridge_stream(spark, f"{root}/arrivals", arrival.schema, B.TRANSFERS_SPEC, root, prices, chains, tokens)
    daily = spark.read.parquet(f"{root}/bridge_d")
    return daily.filter((F.col("bdate") >= F.lit(EV_START)) & (F.col("bdate") < F.lit(EV_END)))


# --- quality -------------------------------------------------------------------
def q_count_reconciliation(spark, sf_dir):
    """One table that agrees, one within its tolerance and one that fails, over all rows.

    The landings of the last two were read earlier than the source is now: the snapshot a
    little before its end (orders of the last days are missing, few enough for the tolerance or not), the closed orders
    as of UNTIL_END.
    """
    root = shared_dir(spark, "recon")
    tag = "mf_" + root.rsplit("/", 1)[-1] + "_"
    batch = Batch(spark, EV_START, EV_END, root, BATCH_TS, tag)
    spec = DatasetSpec("events", "events", "ts", time_kind="timestamp", select=("event_id", "user_id", "event_type", "value", "ts"))
    ev_path = batch.land(_events(spark, sf_dir), spec)
    orders = Batch(spark, ALL_START, ALL_END, root, BATCH_TS, tag)
    snap_spec = replace(B.SNAPSHOT_SPEC, partition_cols=())
    closed_spec = replace(B.CLOSED_SPEC, mode=OVERWRITE, partition_cols=())
    live, closed = B.order_rows(spark, sf_dir), B.closed_orders(spark, sf_dir)
    snap_path = orders.land(live.filter(slice_predicate("created_at", "epoch", None, SNAP_END)), snap_spec)
    closed_path = orders.land(closed.filter(slice_predicate("closed_at", "epoch", None, UNTIL_END)), closed_spec)
    return checks.reconcile_counts(
        [
            batch.counts(_events(spark, sf_dir), spec, ev_path),
            orders.counts(live, snap_spec, snap_path),
            replace(orders.counts(closed, closed_spec, closed_path), tolerance=0),
        ]
    )


def ledger_rows(spark, sf_dir) -> DataFrame:
    """A ledger as long as the events: each event is an attempt of its user's table in the batch of its day.

    Attempts of a batch are numbered by time; an attempt fails where the event is an error.
    """
    events = _events(spark, sf_dir).filter(slice_predicate("ts", "timestamp", EV_START, EV_END))
    day = F.to_date("ts")
    nth = F.row_number().over(Window.partitionBy("user_id", day).orderBy("ts", "event_id"))
    return events.select(
        F.lit("events").alias("schema_name"), F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        F.date_format(day, "yyyy-MM-dd 01:00:00").alias("batch_ts"), nth.cast("int").alias("attempt"),
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(1).alias("status"), day.cast("string").alias("batch_bdate"),
    )


def q_latest_status(spark, sf_dir):
    """Q9 over a ledger of every event, appended day by day and read back, and the rows of three real publishes
    (one done, one whose registration failed, one done on retry)."""
    root = shared_dir(spark, "status")
    ledger, name = f"{root}/etl_status", "mf_" + root.rsplit("/", 1)[-1]
    rows = ledger_rows(spark, sf_dir).withColumn("start_date", F.col("batch_bdate")).withColumn("end_date", F.col("batch_bdate"))
    rows = rows.withColumn("emptied_days", F.lit(None).cast("string")).select([f.name for f in writes.LEDGER_SCHEMA.fields])
    rows.write.mode("append").partitionBy("batch_bdate").parquet(ledger)
    daily = event_daily(spark, sf_dir, EV_START, EV_END)

    def put(table, catalog_name):
        job = writes.JobInfo("events", "dm", table, EV_START, EV_END, BATCH_TS)
        with contextlib.suppress(Exception):
            writes.publish(spark, daily, job, root, ledger, catalog_name=catalog_name)

    put("event_d", name)
    put("event_failed_d", "no_such_schema.event_d")
    put("event_retried_d", "no_such_schema.event_d")
    put("event_retried_d", f"{name}_r")
    return checks.latest_status(spark.read.schema(writes.LEDGER_SCHEMA).parquet(ledger))


def q_latest_status_compacted(spark, sf_dir):
    """Q9 over the ledger of every event, appended in three runs and then merged to one file per day."""
    root = shared_dir(spark, "status")
    rows = ledger_rows(spark, sf_dir)
    rows = rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in writes.LEDGER_SCHEMA.fields]
    )
    for k in range(3):
        rows.filter(F.col("attempt") % 3 == k).write.mode("append").partitionBy("batch_bdate").parquet(root)
    writes.compact_ledger(spark, root, EV_END)
    return checks.latest_status(spark.read.schema(writes.LEDGER_SCHEMA).parquet(root))


def q_max_timestamp(spark, sf_dir):
    return checks.max_timestamp(
        {
            "events": (landed_events(spark, sf_dir), "ts_utc"),
            "user_orders": (landed_snapshot(spark, sf_dir), "ts_utc"),
            "match_histories": (landed_fills(spark, sf_dir), "ts_utc"),
        }
    )


def q_freshness_equal(spark, sf_dir):
    return checks.freshness_equal(landed_events(spark, sf_dir), "dt_utc", midnight_price_df(spark, sf_dir), "bdate")


QUERIES: dict[str, Query] = {
    "scan_time_slice": q_scan_time_slice,
    "scan_until": q_scan_until,
    "scan_projection": q_scan_projection,
    "scan_extra_predicate": q_scan_extra_predicate,
    "scan_borrow_timestamp": q_scan_borrow_timestamp,
    "scan_partition_list": q_scan_partition_list,
    "hex_normalise": q_hex_normalise,
    "dual_zone_columns": q_dual_zone_columns,
    "dual_zone_rows": q_dual_zone_rows,
    "json_items_explode": q_json_items_explode,
    "json_flatten": q_json_flatten,
    "json_contracts": q_json_contracts,
    "safe_numeric_casts": q_safe_numeric_casts,
    "order_details": q_order_details,
    "order_details_bucketed": q_order_details_bucketed,
    "order_daily": q_order_daily,
    "trade_details": q_trade_details,
    "trade_daily": q_trade_daily,
    "fee_daily": q_fee_daily,
    "order_matches_daily": q_order_matches_daily,
    "open_order_tvl": q_open_order_tvl,
    "trade_daily_with_tvl": q_trade_daily_with_tvl,
    "bridge_details": q_bridge_details,
    "bridge_daily": q_bridge_daily,
    "midnight_price": q_midnight_price,
    "closest_to_midnight": q_closest_to_midnight,
    "dau": q_dau,
    "wau": q_wau,
    "mau": q_mau,
    "cumulative_users": q_cumulative_users,
    "new_users": q_new_users,
    "user_summary": q_user_summary,
    "partition_replace": q_partition_replace,
    "partitioned_overwrite": q_partitioned_overwrite,
    "unpartitioned_replace": q_unpartitioned_replace,
    "table_by_version": q_table_by_version,
    "partitioned_by_version": q_partitioned_by_version,
    "emptied_days": q_emptied_days,
    "skip_empty": q_skip_empty,
    "default_slice": q_default_slice,
    "point_scan": q_point_scan,
    "append_only": q_append_only,
    "publish_guarded": q_publish_guarded,
    "landing_publish": q_landing_publish,
    "daily_from_landed": q_daily_from_landed,
    "stream_landing": q_stream_landing,
    "bridge_stream": q_bridge_stream,
    "count_reconciliation": q_count_reconciliation,
    "content_reconciliation": q_content_reconciliation,
    "max_timestamp": q_max_timestamp,
    "freshness_equal": q_freshness_equal,
    "trade_daily_with_open_only": q_trade_daily_with_open_only,
    "token_scaling": q_token_scaling,
    "order_details_batched": q_order_details_batched,
    "order_daily_batched": q_order_daily_batched,
    "order_daily_delta": q_order_daily_delta,
    "activity_bitmaps": q_activity_bitmaps,
    "user_summary_batched": q_user_summary_batched,
    "chain_stats_batched": q_chain_stats_batched,
    "chain_stats_backfill": q_chain_stats_backfill,
    "landing_token": q_landing_token,
    "landing_stats": q_landing_stats,
    "landing_contracts": q_landing_contracts,
    "json_bad_pages": q_json_bad_pages,
    "latest_status": q_latest_status,
    "latest_status_compacted": q_latest_status_compacted,
}
