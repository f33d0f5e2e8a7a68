"""Order marts kept up to date by signed deltas: D2's moved rows, D3's totals, D7's bitmaps.

A batch ``[start, end)`` lands the orders that were created and those that were closed in it,
looks up the open rows of the closed ones in the creation periods they name, and merges exact
signed totals by the raw D3 keys into the totals of the reporting days that changed. Names of pairs and
tokens are attached when totals are read, so a renamed pair does not have to be
rewritten. Periods are days, or months where days hold few rows; slices must start and end
on them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.scalars import cancelled_flag
from martforge.operators import bitmaps
from martforge.operators.deltas import TotalSpec, live, moved_rows, next_state, periods_in
from martforge.operators.timeslice import WEEK, DateLike, as_date, cover_zones, deal_by_week, fan_out_zones
from martforge.plans import marts
from martforge.plans.daily import Batch, DexSources
from martforge.quality import checks
from martforge.sinks import writes
from martforge.sources.scans import APPEND, DatasetSpec, land

ORDER_KEYS = ("order_id", "pair_address")
DAYS, MONTHS = "day", "month"
#: Both zones' days of a row lie before this day.
FOREVER = _dt.date(9999, 12, 31)

ORDER_TOTALS = TotalSpec(
    keys=("period", "timezone_type", "bdate", "pair_address", "owner", "order_side", "is_cancelled"),
    sums=("price", "price_usd", *marts.ORDER_DAILY_SUMS),
)


def period_of(day: Column, period: str) -> Column:
    return (F.trunc(day, "month") if period == MONTHS else day).cast("date").alias("period")


def _aligned(start: DateLike, end: DateLike, period: str) -> None:
    if period not in (DAYS, MONTHS):
        raise ValueError(f"unknown period {period!r}")
    if period == MONTHS and not as_date(start).day == as_date(end).day == 1:
        raise ValueError("slices of monthly partitions must start and end on the first of a month")


def order_values(rows: DataFrame) -> DataFrame:
    """The columns that D3 groups and sums, from raw orders (same rules as D2)."""
    return rows.select(
        "dt_utc", "dt_kst", "ts_utc", "pair_address", "owner", "order_side", cancelled_flag("closed_type").alias("is_cancelled"), "sign",
        "price", F.col("price_usd_at").alias("price_usd"), "amount", (F.col("price_usd_at") * F.col("amount")).alias("amount_usd"),
        "filled", F.col("filled_usd_at").alias("filled_usd"), "volume", F.col("volume_usd_at").alias("volume_usd"), "filled_volume",
        F.col("filled_usd_at").alias("filled_volume_usd"),
    )


def order_delta(moved: DataFrame, period: str = DAYS) -> DataFrame:
    """Signed D3 totals by raw keys, of both zones' days whether or not they have ended."""
    orders = order_values(moved.filter(cover_zones(None, FOREVER))).drop("ts_utc")
    zoned = fan_out_zones(deal_by_week(orders, "owner", "pair_address"), None, FOREVER)
    return ORDER_TOTALS.signed(zoned.withColumn("period", period_of(F.col("bdate"), period)), WEEK).drop(WEEK)


def order_daily_of_totals(totals: DataFrame, pairs: DataFrame, tokens: DataFrame, end: DateLike) -> DataFrame:
    """D3 from the totals: days before ``end``, names attached, groups as in ``marts.order_daily``."""
    shown = live(totals).filter(F.col("bdate") < F.lit(as_date(end)))
    named = marts._with_pair_and_tokens(shown, pairs, tokens)
    return named.groupBy(*marts.ORDER_DAILY_KEYS).agg(
        ORDER_TOTALS.average("price").alias("avg_price"),
        ORDER_TOTALS.average("price_usd").alias("avg_price_usd"),
        *[ORDER_TOTALS.total(c).cast(marts.MONEY).alias(c) for c in marts.ORDER_DAILY_SUMS],
    )


class OrderMoves(RuntimeError):
    """Closed orders that a delta cannot follow: closed twice, or before they were created."""


def _land_slice(batch: Batch, df: DataFrame, spec: DatasetSpec, time_col: str, period: str) -> tuple[str, DataFrame]:
    """Land a slice by the period of ``time_col``; reconcile source, files and read-back."""
    spec = DatasetSpec(spec.service, spec.table, time_col, spec.time_kind, APPEND, ("period",), spec.select, spec.predicate, spec.fmt)
    rows = land(df, spec, batch.start, batch.end).withColumn("period", period_of(F.col("dt_utc"), period))
    job = writes.JobInfo(spec.service, "dl", spec.name, batch.start, batch.end, batch.batch_ts)
    path = writes.publish(batch.spark, rows, job, batch.root, batch.ledger, ["period"])
    days = (F.col("period") >= F.lit(as_date(batch.start))) & (F.col("period") < F.lit(as_date(batch.end)))
    seen = read_or_none(batch.spark, path)
    seen = rows.limit(0) if seen is None else seen.filter(days)
    checks.assert_all_passed(checks.reconcile_counts([checks.CountSources(spec.service, spec.name, rows, seen, seen)]))
    return path, seen


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None where nothing was written yet."""
    if not writes.path_exists(spark, path):
        return None
    files = spark.read.option("recursiveFileLookup", "false")
    try:
        return files.parquet(path)
    except Exception as exc:  # a folder of a table whose first batches were empty
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def open_rows_of(history: DataFrame | None, closed: DataFrame, created: DataFrame, start: DateLike, period: str) -> DataFrame:
    """Open rows created before the slice, of the periods in which orders of ``closed`` were created."""
    if history is None:
        return created.limit(0)
    was_created = closed.select(period_of(F.timestamp_add("SECOND", F.col("created_at"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")), period))
    touched = [p for p in periods_in(was_created, "period") if p < as_date(start)]
    return history.filter(F.col("period").isin(touched))


def run_order_delta(
    spark: SparkSession, src: DexSources, start: DateLike, end: DateLike, root: str, batch_ts: _dt.datetime, period: str = DAYS, with_bitmaps: bool = False
) -> Mapping[str, object]:
    """One batch of the order side as a delta. Returns the paths and the periods that changed.

    Rows are landed first, so a batch that stops anywhere can be run again: it lands the same
    slices, and the periods that already hold it are left alone. Batches must be run in order.
    """
    _aligned(start, end, period)
    batch = Batch(spark, start, end, root, batch_ts)
    closed_path, closed = _land_slice(batch, src.closed, src.closed_spec, "closed_at", period)
    created_path, created = _land_slice(batch, src.snapshot, src.snapshot_spec, "created_at", period)
    checks.assert_unique(closed, list(ORDER_KEYS), src.closed_spec.name)
    if not closed.filter("closed_at < created_at").isEmpty():
        raise OrderMoves(f"{src.closed_spec.name}: closed before it was created")
    earlier = open_rows_of(read_or_none(spark, created_path), closed, created, start, period)
    delta = order_delta(moved_rows(closed, created, earlier, ORDER_KEYS), period)
    path = writes.table_path(root, "dex", "dw", "order_totals")
    new = next_state(spark, ORDER_TOTALS, delta, read_or_none(spark, path), "period", as_date(end).isoformat())
    out = {"close_orders": closed_path, "user_orders": created_path, "order_totals": path, "periods": periods_in(new, "period")}
    batch.publish(new, "dex", "dw", "order_totals", ["period"], drop_empty=False)
    if with_bitmaps:
        out |= activity_batch(batch, path, out["periods"])
    return out


def activity_batch(batch: Batch, totals_path: str, periods: list) -> dict[str, object]:
    """D7's activity of the periods that changed: new owners get numbers, their days get new bitmaps."""
    spark, stamp = batch.spark, as_date(batch.end).isoformat()
    totals = spark.read.parquet(totals_path).filter(F.col("period").isin(periods))
    seen = live(totals).select("period", "timezone_type", "bdate", "owner").distinct()
    owners_path = writes.table_path(batch.root, "dex", "dw", "owner_numbers")
    numbers = read_or_none(spark, owners_path)
    fresh = bitmaps.new_numbers(seen, "owner", None if numbers is None else numbers.filter(F.col("batch") < F.lit(stamp)))
    batch.publish(fresh.withColumn("batch", F.lit(stamp)), "dex", "dw", "owner_numbers", ["batch"], drop_empty=False)
    numbers = spark.read.schema("owner string, number bigint, batch string").parquet(owners_path)
    maps = bitmaps.construct(seen, numbers, ["period", "timezone_type", "bdate"], "owner")
    # a period without rows any more has to lose its bitmaps as well
    markers = spark.createDataFrame([(p,) for p in periods], "period date").select(
        "period", *[F.lit(None).cast(kind).alias(c) for c, kind in maps.dtypes if c != "period"]
    )
    path = batch.publish(maps.unionByName(markers), "dex", "dm", "activity_bitmaps", ["period"], drop_empty=False)
    return {"owner_numbers": owners_path, "activity_bitmaps": path}
