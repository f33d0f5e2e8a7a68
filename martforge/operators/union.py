"""N-ary UNION ALL by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*dfs: DataFrame | None) -> DataFrame | None:
    """UNION ALL by name; non-DataFrames are skipped, none -> None, one -> itself.

    Strict: every input must carry the same column names.
    """
    valid = [d for d in dfs if isinstance(d, DataFrame)]
    if not valid:
        return None
    if len(valid) == 1:
        return valid[0]
    return reduce(lambda a, b: a.unionByName(b), valid)
