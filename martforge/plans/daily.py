"""One daily batch of the DEX subject area, end to end, for ``[start, end)``.

The order follows the source system's job chain: land the sources (dl), build
detail tables (dw) and daily marts (dm) from the *landed* tables, publish each
with the run ledger; counts are reconciled before any mart is built. It is a plain job script over the
library's operators - no scheduling or resume logic. Marts read only the
partitions their slice needs:

* detail tables read the landed UTC days ``[start, end)``;
* dual-zone marts read detail days ``[start - 1, end)`` (a KST day starts at
  15:00 UTC of the previous day);
* order marts and the user summary need the history before ``end`` and are replaced as
  a whole, because a closed order moves between days.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martforge.operators import activity
from martforge.operators.timeslice import DateLike, fan_out_zones, in_range, shift_days
from martforge.plans import marts
from martforge.plans.landing import land_table
from martforge.quality import checks
from martforge.sinks import writes
from martforge.sources.partitions import read_days, read_landed_for_zones
from martforge.sources.scans import OVERWRITE, DatasetSpec, land


@dataclass(frozen=True)
class DexSources:
    """Source DataFrames (JDBC or files) and their landing specs."""

    closed: DataFrame
    snapshot: DataFrame
    fills: DataFrame
    fees: DataFrame        # already carrying time_utc (see sources.borrow)
    pairs: DataFrame
    tokens: DataFrame      # the token dimension (already landed)
    closed_spec: DatasetSpec
    snapshot_spec: DatasetSpec
    fills_spec: DatasetSpec
    fees_spec: DatasetSpec
    pairs_spec: DatasetSpec = DatasetSpec("dex", "pair_infos", None, mode=OVERWRITE, partition_cols=())


@dataclass(frozen=True)
class Batch:
    """What all steps of one batch share."""

    spark: SparkSession
    start: DateLike
    end: DateLike
    root: str
    batch_ts: _dt.datetime
    catalog: str | None = None  # prefix of catalog names, e.g. ``dex.``; None: tables are not registered

    @property
    def ledger(self) -> str:
        return f"{self.root}/etl_status"

    def name(self, layer: str, table: str) -> str | None:
        return f"{self.catalog}{layer}_{table}" if self.catalog is not None else None

    def land(self, df: DataFrame, spec: DatasetSpec, start: DateLike | None = None, end: DateLike | None = None, layer: str = "dl") -> str:
        return land_table(
            self.spark, df, spec, start or self.start, end or self.end, self.root, self.ledger, self.batch_ts, self.name(layer, spec.name), layer
        )

    def publish(
        self, df: DataFrame, schema: str, layer: str, table: str, cols=None, start: DateLike | None = None, how: str = writes.PARTITIONS,
        drop_empty: bool = True,
    ) -> str:
        job = writes.JobInfo(schema, layer, table, start or self.start, self.end, self.batch_ts)
        return writes.publish(self.spark, df, job, self.root, self.ledger, cols, self.name(layer, table), how=how, drop_empty=drop_empty)

    def counts(self, df: DataFrame, spec: DatasetSpec, path: str, start: DateLike | None = None, end: DateLike | None = None) -> checks.CountSources:
        """Source slice, written files and catalog (or the table's own partition listing) of a landed table."""
        lo, hi = start or self.start, end or self.end
        seen = self.spark.table(self.name("dl", spec.name)) if self.catalog is not None else self.spark.read.parquet(path)
        if spec.mode == OVERWRITE or not spec.time_field:
            return checks.CountSources(spec.service, spec.name, land(df, spec, lo, hi), self.spark.read.parquet(path), seen, SNAPSHOT_TOLERANCE)
        return checks.CountSources(spec.service, spec.name, land(df, spec, lo, hi), read_days(self.spark, path, lo, hi), seen.filter(in_range("dt_utc", lo, hi)))


#: Rows by which a live snapshot may differ from its landing (a fixed value).
SNAPSHOT_TOLERANCE = 30


def _checked(tables: list[checks.CountSources]) -> DataFrame:
    """The reconciliation report; raises before any mart is built if a table fails."""
    report = checks.reconcile_counts(tables)
    checks.assert_all_passed(report)
    return report


def run_dex_day(
    spark: SparkSession, src: DexSources, start: DateLike, end: DateLike, root: str, batch_ts: _dt.datetime, catalog: str | None = None
) -> Mapping[str, object]:
    """Land, reconcile, build and publish one batch.

    Returns table paths and the reconciliation report (one row per landed table). A
    landing that does not reconcile, or a pair that occurs twice, stops the batch before the marts.
    """
    batch = Batch(spark, start, end, root, batch_ts, catalog)
    sources = (
        (src.closed, src.closed_spec), (src.snapshot, src.snapshot_spec), (src.fills, src.fills_spec),
        (src.fees, src.fees_spec), (src.pairs, src.pairs_spec),
    )
    paths: dict[str, object] = {spec.name: batch.land(df, spec) for df, spec in sources}
    paths["report"] = _checked([batch.counts(df, spec, paths[spec.name]) for df, spec in sources])
    pairs = spark.read.parquet(paths[src.pairs_spec.name])
    checks.assert_unique(pairs, ["pair_address"], src.pairs_spec.name)

    # detail tables and marts from the landed tables
    fills = read_days(spark, paths[src.fills_spec.name], start, end)
    trade_details = marts.trade_details(fills, pairs, src.tokens, start, end)
    paths["trade_details"] = batch.publish(trade_details, "dex", "dw", "trade_details", ["dt_utc"])
    details_days = read_landed_for_zones(spark, paths["trade_details"], start, end)
    paths["trade_d"] = batch.publish(marts.trade_daily(details_days, start, end), "dex", "dm", "trade_d", ["bdate"])

    fees = read_landed_for_zones(spark, paths[src.fees_spec.name], start, end)
    paths["fee_d"] = batch.publish(marts.fee_daily(fees, pairs, src.tokens, start, end), "dex", "dw", "fee_d", ["bdate"])
    paths |= _order_marts(batch, src, paths[src.closed_spec.name], paths[src.snapshot_spec.name], pairs, True)
    return paths


def _order_marts(batch: Batch, src: DexSources, closed: str, snapshot: str, pairs: DataFrame, partitioned: bool, last: str = "user_summary_d") -> dict[str, object]:
    """D2, D3 and D7 over all history before ``end``, each replaced as a whole.

    A closed order moves from its creation day to its close day, which can empty the old day
    and change any earlier metric, so no subset of partitions may be replaced alone.
    """
    spark, end = batch.spark, batch.end
    days, bdays = (["dt_utc"], ["bdate"]) if partitioned else ([], [])
    paths: dict[str, object] = {}
    details = marts.order_details(spark.read.parquet(closed), spark.read.parquet(snapshot), pairs, src.tokens, end)
    paths["order_details"] = batch.publish(details, "dex", "dw", "order_details", days, how=writes.TABLE)
    details_all = spark.read.parquet(paths["order_details"])
    if last in ("order_d", "user_summary_d"):
        paths["order_d"] = batch.publish(marts.order_daily(details_all, end), "dex", "dw", "order_d", bdays, how=writes.TABLE)
    if last == "user_summary_d":
        act = activity.distinct_activity(fan_out_zones(details_all, None, end))
        paths["user_summary_d"] = batch.publish(activity.user_summary(act), "dex", "dm", "user_summary_d", bdays, how=writes.TABLE)
    return paths


def run_order_day(
    spark: SparkSession, src: DexSources, start: DateLike, end: DateLike, root: str, batch_ts: _dt.datetime,
    catalog: str | None = None, partitioned: bool = True, last: str = "user_summary_d",
) -> Mapping[str, object]:
    """The order side of a batch alone: closed orders and snapshot -> D2, D3, D7 (up to ``last``)."""
    batch = Batch(spark, start, end, root, batch_ts, catalog)
    sources = ((src.closed, src.closed_spec), (src.snapshot, src.snapshot_spec))
    paths: dict[str, object] = {spec.name: batch.land(df, spec) for df, spec in sources}
    paths["report"] = _checked([batch.counts(df, spec, paths[spec.name]) for df, spec in sources])
    return paths | _order_marts(batch, src, paths[src.closed_spec.name], paths[src.snapshot_spec.name], src.pairs, partitioned, last)


@dataclass(frozen=True)
class BridgeSources:
    """Bridge-history, token-price and chain-stat sources plus dimensions."""

    history: DataFrame
    prices: DataFrame
    stats: DataFrame
    chains: DataFrame
    tokens: DataFrame
    history_spec: DatasetSpec
    prices_spec: DatasetSpec
    stats_spec: DatasetSpec


def run_stats_day(
    spark: SparkSession, stats: DataFrame, spec: DatasetSpec, start: DateLike, end: DateLike, root: str, batch_ts: _dt.datetime,
    tie_cols: tuple[str, ...] = ("ts_utc",), catalog: str | None = None,
) -> Mapping[str, object]:
    """Chain stats -> midnight pick. The look-ahead day (I3) is landed too, since its
    00:00-00:04 samples close the last day of the slice; the next batch lands it again."""
    batch = Batch(spark, start, end, root, batch_ts, catalog)
    after = shift_days(end, 1)
    path = batch.land(stats, spec, end=after)
    report = _checked([batch.counts(stats, spec, path, end=after)])
    seen = read_landed_for_zones(spark, path, start, after)
    picked = marts.chain_stats_daily(seen, start, end, tie_cols)
    return {spec.name: path, "stats_report": report, "chain_stats_d": batch.publish(picked, "bridge", "dw", "chain_stats_d")}


def run_bridge_day(
    spark: SparkSession,
    src: BridgeSources,
    start: DateLike,
    end: DateLike,
    root: str,
    batch_ts: _dt.datetime,
    lookback_days: int = 1,
    stats_tie_cols: tuple[str, ...] = ("ts_utc",),
    catalog: str | None = None,
) -> Mapping[str, object]:
    """One bridge/wallet batch: prices -> daily price mart, transfers (with a
    look-back so late status updates and the previous day's price are
    refreshed) -> details -> daily bridge mart, chain stats -> midnight pick.
    Landings that do not reconcile, or a token that occurs twice, stop it before the marts."""
    batch = Batch(spark, start, end, root, batch_ts, catalog)
    first = shift_days(start, -lookback_days)
    paths: dict[str, object] = {
        src.history_spec.name: batch.land(src.history, src.history_spec, first),
        src.prices_spec.name: batch.land(src.prices, src.prices_spec),
    }
    paths["report"] = _checked(
        [
            batch.counts(src.history, src.history_spec, paths[src.history_spec.name], first),
            batch.counts(src.prices, src.prices_spec, paths[src.prices_spec.name]),
        ]
    )
    checks.assert_unique(src.tokens, ["address", "chain_id"], "token")
    prices = read_landed_for_zones(spark, paths[src.prices_spec.name], start, end)
    paths["token_price_d"] = batch.publish(marts.midnight_price(prices, src.tokens, start, end), "wallet", "dm", "token_price_d")
    history = read_days(spark, paths[src.history_spec.name], first, end)
    details = marts.bridge_details(history, src.chains, src.tokens, start, end, lookback_days)
    paths["bridge_details"] = batch.publish(details, "bridge", "dw", "bridge_details", ["dt_utc"], first)
    daily_price = spark.read.parquet(paths["token_price_d"])
    detail_days = read_landed_for_zones(spark, paths["bridge_details"], first, end)
    daily = marts.bridge_daily(detail_days, daily_price, src.tokens, start, end, lookback_days)
    paths["bridge_d"] = batch.publish(daily, "bridge", "dm", "bridge_d", None, first)
    return paths | run_stats_day(spark, src.stats, src.stats_spec, start, end, root, batch_ts, stats_tie_cols, catalog)
