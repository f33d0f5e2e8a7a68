"""Landing jobs D12-D15: source -> landed (dl / dim) tables, published.

Each job is a composition of a source operator and a sink:
* D12 ``land_table``: slice / snapshot / projection of a source (S1-S5) ->
  partition-replacing publish (K1/K3/K2 by spec) with ledger and catalog.
* D13 ``land_token_list``: token API pages (S10) -> unpartitioned replace (K2).
* D14 ``land_chain_stats``: stats object (S11) with a load stamp -> append (K4).
* D15 ``land_contracts`` / ``land_chains``: contract pages (S12) and the
  literal chain list (S13) -> unpartitioned replace.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from martforge.operators.timeslice import DateLike
from martforge.sinks import writes
from martforge.sources import payloads
from martforge.sources.dims import chain_dim
from martforge.sources.scans import OVERWRITE, DatasetSpec, land


def land_table(
    spark: SparkSession,
    source: DataFrame,
    spec: DatasetSpec,
    start: DateLike,
    end: DateLike,
    root: str,
    ledger_path: str,
    batch_ts: _dt.datetime,
    catalog_name: str | None = None,
    layer: str = "dl",
) -> str:
    """Land one source table for ``[start, end)`` and publish it.

    Snapshot sources (``mode=overwrite``) with a time field are replaced as a
    whole (static overwrite, so rows that moved to another day leave no stale
    copy); sliced sources replace the days of the slice, also those they have no rows of; untimed sources
    are replaced unpartitioned. ``layer`` is ``dim`` for dimensions such as tokens.
    """
    df = land(source, spec, start, end)
    cols = writes.default_partitions(spec.name, spec.partition_cols if spec.partition_cols is not None else (None if spec.time_field else []))
    how = writes.TABLE if spec.mode == OVERWRITE or not spec.time_field else writes.PARTITIONS
    job = writes.JobInfo(spec.service, layer, spec.name, start, end, batch_ts)
    return writes.publish(spark, df, job, root, ledger_path, cols, catalog_name, how=how, fmt=spec.fmt, drop_empty=True)


def _loaded(schema: str, layer: str, table: str, load_ts: _dt.datetime) -> writes.JobInfo:
    """A load without a slice: the day of the load stamp."""
    day = load_ts.date()
    return writes.JobInfo(schema, layer, table, day, day + _dt.timedelta(days=1), load_ts)


def land_token_list(
    spark: SparkSession, pages: DataFrame, root: str, ledger_path: str, load_ts: _dt.datetime,
    schema: str = "bridge", table: str = "token", catalog_name: str | None = None, layer: str = "dl",
) -> str:
    """Token pages -> typed token table, full replace (no partitions)."""
    job = _loaded(schema, layer, table, load_ts)
    return writes.publish(spark, payloads.token_items(pages), job, root, ledger_path, [], catalog_name, how=writes.TABLE)


def land_chain_stats(
    spark: SparkSession, stats_payloads: DataFrame, load_ts: _dt.datetime, root: str, ledger_path: str, catalog_name: str | None = None
) -> str:
    """One stats object per poll, appended under its load day (``dt_utc``)."""
    job = _loaded("bridge", "dl", "chain_stats", load_ts)
    rows = payloads.chain_stats(stats_payloads, load_ts)
    return writes.publish(spark, rows, job, root, ledger_path, ["dt_utc"], catalog_name, how=writes.APPEND)


def land_contracts(
    spark: SparkSession, pages: DataFrame, root: str, ledger_path: str, load_ts: _dt.datetime, catalog_name: str | None = None
) -> str:
    """Verified contracts dimension, unpartitioned full replace."""
    job = _loaded("bridge", "dim", "contract", load_ts)
    return writes.publish(spark, payloads.contracts(pages), job, root, ledger_path, [], catalog_name, how=writes.TABLE)


def land_chains(spark: SparkSession, root: str, ledger_path: str, load_ts: _dt.datetime, catalog_name: str | None = None) -> str:
    """The literal chain dimension, unpartitioned full replace."""
    job = _loaded("bridge", "dim", "chain", load_ts)
    return writes.publish(spark, chain_dim(spark), job, root, ledger_path, [], catalog_name, how=writes.TABLE)
