"""Signed deltas (I4): totals that follow moved rows without reading all history again.

A row that moves between groups is taken out of the old one (-1) and put into the new one (+1).
``TotalSpec.signed`` sums such rows per key: the sum of the signs, and for each column the exact sum
and the number of values in it, so that a column whose values are all NULL still
totals NULL and an average can be formed. Totals add up: state + delta is the new state.

The state is a table partitioned by a period (a day or a month). A batch rewrites only the
periods in its delta; every row carries the batch its period was last
merged with, so a batch that is run again skips the periods that already hold it. A period whose
rows are all gone keeps one marker row (n = 0).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.union import union_by_name
from martforge.session import materialize

SIGN, ROWS, BATCH = "sign", "n", "through"


def moved_rows(closed: DataFrame, created: DataFrame, earlier: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a ``sign`` that bring a table of open and closed rows up to date (J6 as a delta).

    ``closed`` and ``created``: rows that were closed or created in the slice; ``earlier``: open rows
    created before it, of at least the periods in which the closed ones were created. A row that
    closes replaces its open form; it closes once, and not before it is created.
    """
    done = closed.withColumn(SIGN, F.lit(1))
    fresh = created.join(closed.select(*keys), list(keys), "left_anti").withColumn(SIGN, F.lit(1))
    gone = earlier.join(closed.select(*keys), list(keys), "left_semi").withColumn(SIGN, F.lit(-1))
    return union_by_name(done, fresh, gone)


@dataclass(frozen=True)
class TotalSpec:
    """Group keys and summed columns of a table of totals."""

    keys: tuple[str, ...]
    sums: tuple[str, ...]

    def columns(self) -> list[str]:
        return [*self.keys, ROWS, *self.sums, *(f"{c}_cnt" for c in self.sums)]

    def signed(self, rows: DataFrame, *dealt: str) -> DataFrame:
        """Totals of rows with a ``sign`` of 1 or -1; exact for decimals.

        ``dealt``: further columns, each with one value per group, that the rows were dealt by.
        """
        scale = {f.name: getattr(f.dataType, "scale", 0) for f in rows.schema.fields}
        return rows.groupBy(*dealt, *self.keys).agg(
            F.sum(SIGN).cast("long").alias(ROWS),
            *[F.coalesce(F.sum(F.col(c) * F.col(SIGN)), F.lit(0)).cast(f"decimal(38,{scale[c]})").alias(c) for c in self.sums],
            *[F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col(SIGN))), F.lit(0)).cast("long").alias(f"{c}_cnt") for c in self.sums],
        )

    def merged(self, state: DataFrame, delta: DataFrame) -> DataFrame:
        """state + delta; groups without rows are left out."""
        both = state.select(*self.columns()).unionByName(delta.select(*self.columns()))
        kinds = dict(both.dtypes)
        out = both.groupBy(*self.keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in self.columns() if c not in self.keys])
        return out.filter(F.col(ROWS) != 0).select(*self.columns())

    def total(self, c: str) -> Column:
        """The column's sum, NULL if it has no value."""
        return F.when(F.sum(f"{c}_cnt") > 0, F.sum(c))

    def average(self, c: str) -> Column:
        return F.try_divide(F.sum(c).cast("double"), F.sum(f"{c}_cnt"))


class NegativeCount(RuntimeError):
    """A delta takes out rows that the state does not hold."""


def periods_in(df: DataFrame, period: str) -> list:
    """Distinct periods of a table: no more than days in its calendar, so they fit on the driver."""
    return sorted(r[0] for r in df.select(period).distinct().collect())


def next_state(spark: SparkSession, spec: TotalSpec, delta: DataFrame, state: DataFrame | None, period: str, batch: str) -> DataFrame:
    """The new rows of all periods that ``delta`` changes and that do not hold ``batch`` yet.

    Only those partitions of ``state`` are read, and only periods it holds are merged: the delta has one row
    per group, so that of a new period is its state. The result is materialised, so it may replace
    partitions of the very table it was read from.
    """
    if period not in spec.keys:
        raise ValueError(f"the period {period} must be one of the keys")
    delta = materialize(delta)
    touched = periods_in(delta, period)
    kinds = dict(delta.select(*spec.columns()).dtypes)
    held = []
    if state is not None:
        old = state.filter(F.col(period).isin(touched))
        merged = {r[0]: r[1] for r in old.groupBy(period).agg(F.max(BATCH)).collect()}
        touched = [p for p in touched if merged.get(p, "") < batch]
        held = [p for p in touched if p in merged]
        old = old.filter(F.col(period).isin(held))
    fresh = [p for p in touched if p not in held]
    new = delta.filter(F.col(period).isin(fresh) & (F.col(ROWS) != 0)).select(*spec.columns())
    if held:
        new = new.unionByName(spec.merged(old.filter(F.col(ROWS) > 0), delta.filter(F.col(period).isin(held))))
    markers = spark.createDataFrame([(p,) for p in touched], f"{period} {kinds[period]}")
    markers = markers.select(*[F.col(c) if c == period else F.lit(0 if c == ROWS else None).cast(kinds[c]).alias(c) for c in spec.columns()])
    out = materialize(new.unionByName(markers).withColumn(BATCH, F.lit(batch)))
    if not out.filter(F.col(ROWS) < 0).isEmpty():
        raise NegativeCount(f"batch {batch} takes out rows that the state does not hold")
    return out


def live(state: DataFrame) -> DataFrame:
    """The state's groups, without the marker rows."""
    return state.filter(F.col(ROWS) > 0)
