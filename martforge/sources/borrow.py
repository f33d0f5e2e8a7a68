"""Borrow an event time from another table by block number."""

from __future__ import annotations

from pyspark.sql import DataFrame


def borrow_time(rows: DataFrame, timed: DataFrame, key: str = "block", time_col: str = "time_utc") -> DataFrame:
    """``rows LEFT JOIN (SELECT DISTINCT key, time_col FROM timed) USING (key)``.

    The distinct is computed map-side first, so only one row per
    (key, time) crosses the shuffle. A key with two distinct times fans the
    row out, as the SQL form does. A later slice on ``time_col`` removes
    unmatched rows, at which point Catalyst plans the join as inner.
    """
    times = timed.select(key, time_col).distinct()
    return rows.join(times, key, "left")
