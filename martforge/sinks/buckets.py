"""Co-bucketed landings: tables written once by the keys they are joined on.

Every order batch anti-joins open orders with closed ones on (order_id, pair_address). Tables that are
bucketed and sorted by these keys, with one number of buckets, are joined bucket by bucket
without a shuffle of either. A bucket is written by one task, so there is one file for each; the number
of buckets is chosen so that a bucket fits a task (128 MB to 1 GB), and has to be the same for tables
joined with each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as the external catalog table ``name``, bucketed and sorted by ``keys``; returns the table.

    The columns, their order and all rows stay as they are. A table of this name is replaced.
    """
    if buckets < 1 or not keys:
        raise ValueError("a bucketed table needs keys and buckets")
    dealt = df.repartition(buckets, *keys)  # the rows of a bucket in one task
    dealt.write.format(fmt).mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
