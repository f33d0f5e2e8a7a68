"""Half-open time slices and dual time-zone reporting.

Dates are passed as ``datetime.date`` or ``'YYYY-MM-DD'`` and always mean a
half-open range ``[start, end)``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions.scalars import EPOCH_DAY, KST, KST_OFFSET_HOURS, UTC, ZONES, ntz_lit

DateLike = _dt.date | str


def as_date(d: DateLike) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(d)


def shift_days(d: DateLike, days: int) -> _dt.date:
    """Move a slice bound by whole days (look-back / look-ahead)."""
    return as_date(d) + _dt.timedelta(days=days)


def default_slice(today: DateLike) -> tuple[_dt.date, _dt.date]:
    """The daily batch ``[today - 1, today)``; ``today`` is a parameter,
    never read from the wall clock inside a job."""
    t = as_date(today)
    return t - _dt.timedelta(days=1), t


def _dlit(d: DateLike) -> Column:
    return F.lit(as_date(d))


def in_range(c: Column | str, start: DateLike, end: DateLike) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c >= _dlit(start)) & (c < _dlit(end))


def ts_range(c: Column | str, start: DateLike, end: DateLike) -> Column:
    """``start 00:00 <= c < end 00:00`` on a ``timestamp_ntz`` column."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= ntz_lit(as_date(start))) & (c < ntz_lit(as_date(end)))


def filter_by_time(df: DataFrame, start: DateLike, end: DateLike, timefield: str = "dt_utc") -> DataFrame:
    """Keep ``start <= timefield < end`` and type the column as a date.

    The range is applied to the stored column first, so a partition column
    prunes directories and a data column reaches the parquet scan.
    """
    return df.filter(in_range(timefield, start, end)).withColumn(timefield, F.col(timefield).cast("date"))


def filter_by_time_end(df: DataFrame, end: DateLike, timefield: str = "dt_utc") -> DataFrame:
    """Upper bound only."""
    return df.filter(F.col(timefield) < _dlit(end)).withColumn(timefield, F.col(timefield).cast("date"))


def _zone_view(df: DataFrame, zone: str, cond: Column) -> DataFrame:
    other = "dt_kst" if zone == UTC else "dt_utc"
    return (
        df.filter(cond)
        .withColumn("timezone_type", F.lit(zone))
        .withColumnRenamed(f"dt_{zone}", "bdate")
        .withColumn("bdate", F.col("bdate").cast("date"))
        .drop(other)
    )


def filter_by_timezone(df: DataFrame, zone: str, start: DateLike, end: DateLike) -> DataFrame:
    """One zone's rows in ``[start, end)``, tagged, ``dt_<zone>`` -> ``bdate``."""
    return _zone_view(df, zone, in_range(f"dt_{zone}", start, end))


def filter_by_timezone_end(df: DataFrame, zone: str, end: DateLike) -> DataFrame:
    """P3 with an upper bound only."""
    return _zone_view(df, zone, F.col(f"dt_{zone}") < _dlit(end))


def zones_by_union(df: DataFrame, start: DateLike | None, end: DateLike) -> DataFrame:
    """P5 written as two filtered copies and a union (reference shape; tests)."""
    from martforge.operators.union import union_by_name

    if start is None:
        parts = [filter_by_timezone_end(df, z, end) for z in ZONES]
    else:
        parts = [filter_by_timezone(df, z, start, end) for z in ZONES]
    return union_by_name(*parts)


def cover_zones(start: DateLike | None, end: DateLike, ts_col: str = "ts_utc") -> Column:
    """Rows of either zone's days in the slice: ``ts_utc`` in [start - 9 h, end)."""
    cover = F.col(ts_col) < ntz_lit(as_date(end))
    if start is None:
        return cover
    lo = _dt.datetime.combine(as_date(start), _dt.time()) - _dt.timedelta(hours=KST_OFFSET_HOURS)
    return cover & (F.col(ts_col) >= ntz_lit(lo))


def fan_out_zones(
    df: DataFrame,
    start: DateLike | None,
    end: DateLike,
    ts_col: str | None = "ts_utc",
    partition_col: str | None = None,
) -> DataFrame:
    """P5: every row once per reporting zone whose day lies in the slice.

    One scan instead of two: the row is expanded with an inline array of
    ``(timezone_type, bdate)`` pairs and the per-zone day filter is applied
    to the expanded rows. Before expanding, a covering predicate is added so
    the scan still prunes: a KST day ``d`` starts 9 h before UTC ``d``, hence
    ``ts_utc in [start - 9h, end)`` (and ``dt_utc in [start - 1d, end)`` when
    the table is partitioned by ``dt_utc``).

    Output columns: input minus ``dt_utc``/``dt_kst``, plus ``bdate`` and
    ``timezone_type``. Equal to ``zones_by_union``.
    """
    if ts_col is not None and ts_col in df.columns:
        df = df.filter(cover_zones(start, end, ts_col))
    if partition_col is not None and partition_col in df.columns:
        pc = F.col(partition_col) < _dlit(end)
        if start is not None:
            pc = pc & (F.col(partition_col) >= _dlit(shift_days(start, -1)))
        df = df.filter(pc)

    pairs = F.array(
        F.struct(F.lit(UTC).alias("timezone_type"), F.col("dt_utc").cast("date").alias("bdate")),
        F.struct(F.lit(KST).alias("timezone_type"), F.col("dt_kst").cast("date").alias("bdate")),
    )
    rest = [c for c in df.columns if c not in ("dt_utc", "dt_kst")]
    out = df.select(*rest, F.inline(pairs))
    day_ok = F.col("bdate") < _dlit(end)
    if start is not None:
        day_ok = day_ok & (F.col("bdate") >= _dlit(start))
    return out.filter(day_ok)


WEEK = "__week"


def by_week(df: DataFrame) -> DataFrame:
    """Rows with the week of their days as column ``__week``, to be dealt by it before they are fanned out.

    A row whose days lie in two weeks comes once in each, with the other day NULL (``fan_out_zones``
    drops NULL days), so behind a shuffle by week and key every zone-day of a key is in one place.
    """
    def week(c: str) -> Column:
        return F.floor(F.datediff(F.col(c).cast("date"), F.lit(EPOCH_DAY)) / 7).cast("int")

    def part(number: Column, *kept: str) -> Column:
        return F.struct(number.alias(WEEK), *[(F.col(c) if c in kept else F.lit(None)).cast("date").alias(c) for c in ("dt_utc", "dt_kst")])

    one = F.array(part(week("dt_utc"), "dt_utc", "dt_kst"))
    two = F.array(part(week("dt_utc"), "dt_utc"), part(week("dt_kst"), "dt_kst"))
    rest = [c for c in df.columns if c not in ("dt_utc", "dt_kst")]
    return df.select(*rest, F.inline(F.when(week("dt_utc") == week("dt_kst"), one).otherwise(two)))


def deal_by_week(df: DataFrame, *keys: str) -> DataFrame:
    """``by_week``, dealt by week and ``keys`` over all shuffle partitions.

    Groups are wider than the rows they are made of, so the partitions must not be merged by the rows' size.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_week(df).repartition(tasks, WEEK, *keys)


def clip_days(df: DataFrame, start: DateLike, end: DateLike, col: str = "bdate") -> DataFrame:
    """Re-apply ``[start, end)`` after dates were adjusted."""
    return df.filter(in_range(col, start, end))
