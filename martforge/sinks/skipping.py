"""Data skipping (S1 / S4 / K1): files laid out so that a point scan reads few of them.

A table clustered by day keeps every owner and pair in every file, so a scan for one owner reads the
whole slice. Here rows are dealt and sorted by an interleaved-bit (Z-order) key over several columns: each column
is cut into 2**bits ranges of about equal size, and the bits of the range numbers are interleaved.
Rows that are near each other in all columns share files and row groups, so the minima and maxima that
Parquet keeps for a row group exclude most of them for a condition on any of the columns. Columns of
hashes, whose values have no useful order, can get a Parquet bloom filter besides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 10_000
#: A writer keeps the footer of its open file in memory: an entry per column for each row group, and the bloom filters.
FILE_ROWS_PER_GROUP_BYTE = 8    # rows of a file at most, for each byte of a row group
BLOOM_SHARE = 8                 # a bloom filter takes 1/8 of its row group at most,
BLOOM_MAX, BLOOM_MIN = 1 << 20, 1 << 10  # and 1 MB (Parquet's default, taken whole unless it is lowered) at most


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each column the values that cut it into up to 2**bits ranges, from a bounded sample of rows.

    Rows of the smallest hashes are sampled, so the bounds do not depend on partitioning. They only
    decide how rows are laid out, never which rows there are.
    """
    rows = df.select(*columns).orderBy(F.xxhash64(*columns)).limit(sample_rows).collect()  # bounded
    out = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        cuts = [values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)] if values else []
        out[c] = sorted(set(cuts))
    return out


def _not_above(value: Column, cut: Column) -> Column:
    return cut <= value


def interleaved_key(df: DataFrame, bounds: dict[str, list], bits: int) -> Column:
    """The Z-order key of a row: bit i of each column's range number, side by side, as a long."""
    columns = list(bounds)
    if len(columns) * bits > 63:
        raise ValueError("the key has 63 bits at most")
    key = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        if not bounds[c]:
            continue
        kind = df.schema[c].dataType
        cuts = F.array(*[F.lit(v) for v in bounds[c]]).cast(f"array<{kind.simpleString()}>")
        number = F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(F.filter(cuts, partial(_not_above, F.col(c))))).cast("long")
        for i in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1).cast("long")), i * len(columns) + j))
    return key


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6, bloom: Sequence[str] = (), row_group_bytes: int | None = None
) -> None:
    """Write ``df`` in ``files`` files ordered by the Z-order key over ``columns``; all rows, no new column.

    ``files`` is chosen so that a file has 128 MB to 1 GB. ``bloom``: columns with a bloom filter in every row group.
    With small row groups a larger table is written in more files, so that the footer a task holds does not grow
    with the table.
    """
    if row_group_bytes:
        files = max(files, -(-df.count() // (row_group_bytes * FILE_ROWS_PER_GROUP_BYTE)))
    bounds = range_bounds(df, columns, bits)
    keyed = df.withColumn("__z", interleaved_key(df, bounds, bits))
    dealt = keyed.repartitionByRange(files, "__z", *columns).sortWithinPartitions("__z", *columns).drop("__z")
    writer = dealt.write.mode("overwrite")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
        writer = writer.option("parquet.bloom.filter.max.bytes", str(min(BLOOM_MAX, max(BLOOM_MIN, row_group_bytes // BLOOM_SHARE))))
    writer.parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Rows that the file scan of a plan without shuffles hands on, after files and row groups were skipped.

    Runs the plan once. For tests and reports.
    """
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves, total = plan.collectLeaves(), 0
    for k in range(leaves.size()):
        total += leaves.apply(k).metrics().get("numOutputRows").get().value()
    return total
