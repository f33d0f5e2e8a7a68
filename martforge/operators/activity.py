"""User-activity metrics (D7): DAU, forward 7-day WAU, calendar MAU,
cumulative users (RU) and new users (NRU), per (timezone_type, bdate).

Input: rows already fanned out per zone (``timezone_type, bdate, owner``).

The textbook forms - a self join on ``timezone_type`` plus a date range, and
a running ``collect_set`` window partitioned by zone - have at most two hash
keys (two zones) and a window state that grows with the user base, so they do
not scale out. The forms below are equal but shuffle on (zone, day, owner)
and keep every window tiny:

* WAU: each active (zone, day, owner) is credited to the anchor days
  ``day-6 .. day`` that the owner's previous active day did not already
  cover (a ``lag`` over the owner's days - at most one row per day, so even
  a very hot owner is a bounded partition). Every (owner, anchor) pair is
  produced once, so a plain ``count`` (map-side combined) replaces a
  distinct count; anchors that are not active days are dropped by a semi
  join against the active-day set.
* MAU: owners are counted once per (zone, month) and joined back to days.
* NRU: first active day per (zone, owner), counted per day.
* RU: running sum of NRU over the active days of a zone (the window sees
  one row per zone-day only).

All metrics are keyed on the set of active zone-days, as in the join form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["timezone_type", "bdate"]
WAU_DAYS = 7


def distinct_activity(zoned: DataFrame, owner: str = "owner") -> DataFrame:
    """One row per (zone, day, owner)."""
    return zoned.select("timezone_type", F.col("bdate").cast("date").alias("bdate"), F.col(owner).alias("owner")).distinct()


def active_days(activity: DataFrame) -> DataFrame:
    """Active (zone, day) pairs; bounded by 2 x days in range, not by rows."""
    return activity.select(*KEYS).distinct()


def daily_active(activity: DataFrame) -> DataFrame:
    """DAU: distinct non-NULL owners per zone-day (input is already distinct)."""
    return activity.groupBy(*KEYS).agg(F.count("owner").alias("dau"))


def _shared(activity: DataFrame, materialize_input: bool) -> DataFrame:
    """Metrics that read the activity twice (day spine + owners) checkpoint it
    in the shared folder, so the upstream plan is not run twice
    (the two branches prune differently, so Spark cannot reuse the shuffle)."""
    if not materialize_input:
        return activity
    from martforge.session import materialize

    return materialize(activity)


def weekly_active(activity: DataFrame, materialize_input: bool = True) -> DataFrame:
    """Forward WAU: owners active in ``[bdate, bdate + 6]``, for active days."""
    activity = _shared(activity, materialize_input)
    days = active_days(activity)
    per_owner = Window.partitionBy("timezone_type", "owner").orderBy("bdate")
    prev = F.lag("bdate").over(per_owner)
    first_new = F.greatest(F.date_sub("bdate", WAU_DAYS - 1), F.coalesce(F.date_add(prev, 1), F.date_sub("bdate", WAU_DAYS - 1)))
    credited = (
        activity.filter(F.col("owner").isNotNull())
        .select("timezone_type", "owner", "bdate", first_new.alias("__from"))
        .select("timezone_type", F.explode(F.sequence("__from", "bdate")).alias("bdate"))
    )
    credited = credited.join(days, KEYS, "left_semi")
    counts = credited.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("wau"))
    return days.join(counts, KEYS, "left").select(*KEYS, F.coalesce("wau", F.lit(0)).alias("wau"))


def monthly_active(activity: DataFrame, materialize_input: bool = True) -> DataFrame:
    """Calendar MAU: owners active in the month of ``bdate``, for active days."""
    activity = _shared(activity, materialize_input)
    month = F.trunc("bdate", "month")
    per_month = (
        activity.withColumn("month", month)
        .groupBy("timezone_type", "month")
        .agg(F.count_distinct("owner").alias("mau"))
    )
    days = active_days(activity).withColumn("month", month)
    return days.join(per_month, ["timezone_type", "month"], "left").select(
        *KEYS, F.coalesce("mau", F.lit(0)).alias("mau")
    )


def first_visits(activity: DataFrame) -> DataFrame:
    """A10 level 1: first active day per (owner, zone); NULL owner is a group."""
    return activity.groupBy("owner", "timezone_type").agg(F.min("bdate").alias("first_visit"))


def new_users(activity: DataFrame) -> DataFrame:
    """NRU: owners whose first active day is ``bdate`` (A10 level 2)."""
    return (
        first_visits(activity)
        .groupBy("timezone_type", "first_visit")
        .agg(F.count("owner").alias("nru"))
        .withColumnRenamed("first_visit", "bdate")
    )


def cumulative_users(activity: DataFrame, materialize_input: bool = True) -> DataFrame:
    """RU: distinct owners seen up to and including ``bdate`` (per zone)."""
    activity = _shared(activity, materialize_input)
    days = active_days(activity)
    nru = new_users(activity)
    w = Window.partitionBy("timezone_type").orderBy("bdate").rowsBetween(Window.unboundedPreceding, 0)
    return (
        days.join(nru, KEYS, "left")
        .select(*KEYS, F.sum(F.coalesce("nru", F.lit(0))).over(w).alias("ru"))
    )


def _credits() -> Column:
    """What one active (zone, owner, day) adds to which days, given the owner's previous active day ``prev``.

    An owner's day counts for itself (DAU), for the days ``day-6 .. day`` that ``prev`` has not
    credited yet (WAU), for its month if ``prev`` is of another one (MAU, credited to the month's first day) and
    for the first day of all (NRU). A NULL owner only makes its day active.
    """
    known, here = F.col("owner").isNotNull(), F.col("bdate")
    earliest = F.date_sub("bdate", WAU_DAYS - 1)
    first_new = F.greatest(earliest, F.coalesce(F.date_add("prev", 1), earliest))
    as_int = lambda c: c.cast("long")

    def credit(day: Column) -> Column:
        own = day == here
        return F.struct(
            day.alias("bdate"), own.alias("active"), as_int(known & own).alias("dau"), as_int(known).alias("wau"),
            F.lit(0).cast("long").alias("mau"), as_int(known & own & F.col("prev").isNull()).alias("nru"),
        )

    zero = F.lit(0).cast("long")
    month = F.struct(
        F.trunc("bdate", "month").alias("bdate"), F.lit(False).alias("active"), zero.alias("dau"), zero.alias("wau"), F.lit(1).cast("long").alias("mau"), zero.alias("nru")
    )
    days = F.transform(F.when(known, F.sequence(first_new, here)).otherwise(F.array(here)), credit)
    new_month = known & (F.col("prev").isNull() | (F.trunc("prev", "month") != F.trunc("bdate", "month")))
    return F.when(new_month, F.concat(days, F.array(month))).otherwise(days)


def user_summary(activity: DataFrame) -> DataFrame:
    """J9 + P13: the five metrics on the active-day spine, NULL -> 0, sorted.

    One pass over each owner's days credits all metrics and one groupBy counts them, so the
    activity is read and shuffled once and nothing is joined; what follows has a row per zone-day.
    """
    per_owner = Window.partitionBy("timezone_type", "owner").orderBy("bdate")
    seen = activity.select(*KEYS, "owner", F.lag("bdate").over(per_owner).alias("prev"))
    counts = seen.select("timezone_type", F.inline(_credits())).groupBy(*KEYS).agg(
        F.max("active").alias("active"), *[F.sum(m).alias(m) for m in ("dau", "wau", "mau", "nru")]
    )
    month = Window.partitionBy("timezone_type", F.trunc("bdate", "month"))
    running = Window.partitionBy("timezone_type").orderBy("bdate").rowsBetween(Window.unboundedPreceding, 0)
    days = counts.withColumn("mau", F.sum("mau").over(month)).filter("active")
    return days.select(*KEYS, "dau", "wau", "mau", F.sum("nru").over(running).alias("ru"), "nru").orderBy(*KEYS)
