"""Bridge marts as a stream (I2 / D8 / D9): late status updates rewrite only the days they touch.

Transfers arrive as versions: a transfer is first seen when it is initiated and again whenever its
status changes, often days later. A batch job needs a look-back long enough for the latest update; here
each micro-batch

1. merges its versions into the landed table, in the partitions of the UTC days it touches: of a
   transfer the latest version stays;
2. builds the detail rows and the daily mart of the reporting days that these UTC days feed (the day and
   the one after it, where the second zone's day ends) and replaces those partitions.

Both steps give the same tables however often a micro-batch is run (the latest version of a key is not
changed by seeing an older one again), so a restart from the checkpoint, which repeats the last micro-batch at
most, needs no further bookkeeping. Touched days are a few values per micro-batch; rows never reach the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martforge.operators.timeslice import shift_days
from martforge.plans import marts
from martforge.session import materialize
from martforge.sinks import writes
from martforge.sources.scans import DatasetSpec, with_zone_columns


def latest_versions(rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row of the largest version of each key; of rows equal in both the largest by value.

    A map-side combined aggregate, so a key with very many versions is not gathered in one task.
    """
    rest = [c for c in rows.columns if c not in keys and c != version]
    best = F.max(F.struct(version, *rest)).alias("__best")
    return rows.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in rows.columns])


def _days_of(df: DataFrame, column: str) -> list[_dt.date]:
    """Distinct days of a micro-batch."""
    return sorted(r[0] for r in df.select(F.col(column).cast("date").alias("d")).distinct().collect())


def merge_versions(batch: DataFrame, path: str, keys: Sequence[str], version: str, day: str = "dt_utc") -> list[_dt.date]:
    """Merge a micro-batch into the table at ``path``, partitioned by ``day``; returns the days it touches.

    A key's day must not change between its versions. Only the touched partitions are read and replaced.
    """
    spark = batch.sparkSession
    days = _days_of(batch, day)
    if not days:
        return []
    rows = batch
    if writes.path_exists(spark, path):
        old = spark.read.schema(batch.schema).parquet(path).filter(F.col(day).isin(days))
        rows = batch.unionByName(old)
    merged = materialize(latest_versions(rows, keys, version))  # replaces the partitions it was read from
    writes.replace_partitions(merged, path, [day])
    return days


def refresh_marts(
    spark: SparkSession, landed: str, details_path: str, mart_path: str, days: Sequence[_dt.date], prices: DataFrame, chains: DataFrame, tokens: DataFrame
) -> list[_dt.date]:
    """Details of the touched UTC days and the daily mart of the reporting days that they feed."""
    if not days:
        return []
    touched = sorted(set(days))
    reported = sorted({d for day in touched for d in (day, shift_days(day, 1))})
    # a reporting day of the second zone starts on the UTC day before
    needed = sorted({d for day in reported for d in (shift_days(day, -1), day)})
    first, end = needed[0], shift_days(needed[-1], 1)
    history = spark.read.parquet(landed).filter(F.col("dt_utc").isin(needed))
    details = materialize(marts.bridge_details(history, chains, tokens, first, end, 0))
    writes.replace_partitions(details.filter(F.col("dt_utc").isin(touched)), details_path, ["dt_utc"])
    mart = marts.bridge_daily(details, prices, tokens, reported[0], shift_days(reported[-1], 1), 0)
    writes.replace_partitions(mart.filter(F.col("bdate").isin(reported)), mart_path, ["bdate"])
    return reported


def run_bridge_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    spec: DatasetSpec,
    root: str,
    prices: DataFrame,
    chains: DataFrame,
    tokens: DataFrame,
    keys: Sequence[str] = ("_id",),
    version: str = "version",
    max_files_per_trigger: int | None = None,
    seen: Callable[[int, list], None] | None = None,
) -> StreamingQuery:
    """Take in every file of ``source`` that has not been seen yet, then stop.

    Tables lie below ``root``: ``history``, ``bridge_details`` and ``bridge_d``. ``seen(batch, reporting days)``
    is told of every micro-batch.
    """

    def merge(batch: DataFrame, number: int) -> None:
        rows = materialize(with_zone_columns(batch, spec.time_field, spec.time_kind))
        days = merge_versions(rows, f"{root}/history", keys, version)
        reported = refresh_marts(batch.sparkSession, f"{root}/history", f"{root}/bridge_details", f"{root}/bridge_d", days, prices, chains, tokens)
        if seen:
            seen(number, reported)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (
        reader.parquet(source).writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
