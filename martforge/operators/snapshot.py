"""Snapshot-at-midnight selection (W1, F8, I3 helpers).

The reference shape is ``row_number() over (partition by day order by
distance)`` and keep row 1. Here the same pick is an aggregate,
``min_by(row, (distance, tie-breakers...))`` per (zone, day): it combines
map-side, so a day holding a large share of all samples is reduced inside
each input task before the shuffle instead of being sorted in one task.
Ties are broken deterministically by the extra order columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions.scalars import UTC, early_morning_shift, midnight_distance


def zone_ts() -> Column:
    """The sample time on the reporting zone's clock."""
    return F.when(F.col("timezone_type") == UTC, F.col("ts_utc")).otherwise(F.col("ts_kst"))


def closest_to_midnight(zoned: DataFrame, tie_cols: Sequence[str] = ("ts_utc",)) -> DataFrame:
    """D10 core: per (zone, adjusted day) the sample nearest to midnight.

    ``zoned`` has ``timezone_type, bdate, ts_utc, ts_kst`` (from the zone
    fan-out). A sample before 00:05 on the zone clock counts for the previous
    day; distance follows ``midnight_distance``; ties go to the earlier
    ``tie_cols`` tuple.
    """
    zts = zone_ts()
    adjusted = early_morning_shift("bdate", zts)
    payload = [c for c in zoned.columns if c not in ("timezone_type", "bdate")]
    order = F.struct(midnight_distance(zts).alias("distance"), *[F.col(c) for c in tie_cols])
    row = F.struct(*[F.col(f"`{c}`") for c in payload])
    picked = zoned.groupBy(F.col("timezone_type"), adjusted.alias("bdate")).agg(
        F.min_by(row, order).alias("__row")
    )
    return picked.select("timezone_type", "bdate", "__row.*")


def closest_to_midnight_window(zoned: DataFrame, tie_cols: Sequence[str] = ("ts_utc",)) -> DataFrame:
    """The same pick written with ``row_number`` (reference shape; tests)."""
    zts = zone_ts()
    df = zoned.withColumn("__adj", early_morning_shift("bdate", zts)).withColumn(
        "__dist", midnight_distance(zts)
    )
    w = Window.partitionBy("timezone_type", "__adj").orderBy("__dist", *tie_cols)
    return (
        df.withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") == 1)
        .withColumn("bdate", F.col("__adj"))
        .drop("__rn", "__adj", "__dist")
    )
