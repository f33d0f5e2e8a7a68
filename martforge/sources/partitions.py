"""Read only the daily partitions of a slice from a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martforge.operators.timeslice import DateLike, in_range


def read_days(spark: SparkSession, path: str, start: DateLike, end: DateLike, partition_col: str = "dt_utc") -> DataFrame:
    """Rows of the ``partition_col=`` directories for each day of ``[start, end)``.

    The table root is read and filtered on the partition column; Spark
    prunes directories from the filter (``PartitionFilters`` in the plan), so
    no file listing per day and no driver loop is needed. Missing days are
    simply absent.
    """
    return spark.read.parquet(path).filter(in_range(partition_col, start, end))


def read_landed_for_zones(spark: SparkSession, path: str, start: DateLike, end: DateLike, partition_col: str = "dt_utc") -> DataFrame:
    """A ``dt_utc``-partitioned landed table, pruned for dual-zone reporting.

    KST day ``d`` starts at 15:00 UTC of day ``d - 1``, so reporting
    ``[start, end)`` in both zones needs the UTC partitions
    ``[start - 1 day, end)`` and nothing else.
    """
    from martforge.operators.timeslice import shift_days

    return read_days(spark, path, shift_days(start, -1), end, partition_col)
