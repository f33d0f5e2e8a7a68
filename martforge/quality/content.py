"""Content reconciliation (Q4 by content): which keys of a landing differ from its source.

Counts agree where one row was lost and another landed twice, and they say nothing about changed
values. Here both sides are summed up per (day, key bucket) by checksums that do not depend on the
order of rows: the number of rows, and the sum and the exclusive-or of a 64-bit hash of each row. Only
rows of buckets that differ are then compared key by key, by one union and one groupBy. Tables
that agree cost one pass with a map-side aggregate; a landing that differs in a few days or keys shuffles
the rows of those buckets, never both tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGED, LOST, EXTRA = "changed", "lost", "extra"


def _row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row's values; a NULL is told apart from any value by its place."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(*columns, nulls)


def _marked(df: DataFrame, day: str, keys: Sequence[str], columns: Sequence[str], buckets: int, side: int) -> DataFrame:
    """day, keys, bucket and row hash of a table; ``side`` is 1 for the source and -1 for the landing."""
    return df.select(
        F.col(day).alias("day"), *keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        _row_hash([day, *keys, *columns]).alias("h"), F.lit(side).alias("side"),
    )


def differing_buckets(source: DataFrame, landed: DataFrame) -> DataFrame:
    """(day, bucket) whose checksums are not the same on both sides; at most days times buckets rows."""
    per_side = [
        df.groupBy("day", "bucket").agg(
            F.sum("side").cast("long").alias("n"), F.sum(F.col("h").cast("decimal(20,0)") * F.col("side")).alias("s"), F.bit_xor("h").alias("x")
        )
        for df in (source, landed)
    ]
    both = per_side[0].unionByName(per_side[1])
    out = both.groupBy("day", "bucket").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.bit_xor("x").alias("x"))
    return out.filter("n != 0 OR s != 0 OR x != 0").select("day", "bucket")


def key_differences(source: DataFrame, landed: DataFrame, day: str, keys: Sequence[str], columns: Sequence[str], buckets: int = 256) -> DataFrame:
    """keys and ``difference``: lost (only in the source), extra (only landed) or changed.

    ``columns`` are compared besides ``day`` and ``keys``. A key that moved to another day is changed; a
    key of several rows is changed if its rows are not the same ones on both sides. NULL keys and
    days are keys and days of their own.
    """
    left, right = _marked(source, day, keys, columns, buckets, 1), _marked(landed, day, keys, columns, buckets, -1)
    open_ = differing_buckets(left, right).withColumnsRenamed({"day": "open_day", "bucket": "open_bucket"})
    same = F.col("day").eqNullSafe(F.col("open_day")) & (F.col("bucket") == F.col("open_bucket"))
    rows = left.join(open_, same, "left_semi").unionByName(right.join(open_, same, "left_semi"))
    per_key = rows.groupBy(*keys).agg(
        F.count(F.when(F.col("side") == 1, 1)).alias("here"), F.count(F.when(F.col("side") == -1, 1)).alias("there"),
        F.sum(F.col("h").cast("decimal(20,0)") * F.col("side")).alias("s"), F.bit_xor("h").alias("x"),
    )
    kind = F.when(F.col("there") == 0, LOST).when(F.col("here") == 0, EXTRA).when((F.col("here") != F.col("there")) | (F.col("s") != 0) | (F.col("x") != 0), CHANGED)
    return per_key.select(*keys, kind.alias("difference")).filter("difference IS NOT NULL")
