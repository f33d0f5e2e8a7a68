"""Exact distinct counts over days by bitmaps of dense owner numbers.

Each owner gets a dense number once and keeps it. A day's owners are bitmaps of 32,768 numbers
each, one row per (zone, day, bucket), so the activity of any set of days is a
union of bitmaps: owners are not shuffled again for a week, a month or all time. A
bitmap has 4 KB whatever it holds; a day has one for every 32,768 owners ever seen at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators.ranking import positions
from martforge.operators.union import union_by_name

KEYS = ["timezone_type", "bdate"]
WAU_DAYS = 7


def new_numbers(rows: DataFrame, owner: str, known: DataFrame | None) -> DataFrame:
    """(owner, number) of owners that ``known`` does not have, numbered on from its largest."""
    fresh = rows.select(F.col(owner).alias("owner")).filter("owner IS NOT NULL").distinct()
    base = 0
    if known is not None:
        fresh = fresh.join(known.select("owner"), "owner", "left_anti")
        base = (known.agg(F.max("number")).first()[0] or 0)
    return positions(fresh, ["owner"], name="number").select("owner", (F.col("number") + base + 1).alias("number"))


def construct(rows: DataFrame, numbers: DataFrame, keys: Sequence[str], owner: str) -> DataFrame:
    """keys, bucket and bitmap of the owners of each group; bucket 0 with no bit for a NULL owner."""
    numbered = rows.join(numbers.select(F.col("owner").alias(owner), "number"), owner, "left")
    bucket = F.when(F.col("number").isNotNull(), F.bitmap_bucket_number("number")).otherwise(F.lit(0).cast("long"))
    return numbered.groupBy(*keys, bucket.alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def owners_in(bits: Column) -> Column:
    return F.sum(F.bitmap_count(bits))


def metrics(maps: DataFrame) -> DataFrame:
    """DAU, WAU, MAU, RU and NRU per active (zone, day), as ``activity.user_summary``.

    ``maps``: timezone_type, bdate, bucket, bits. Each metric is a union of bitmaps per bucket and a sum of
    their counts; the five are rows of one union and one groupBy brings them together.
    """
    maps = maps.filter("bits IS NOT NULL")
    names = ["dau", "wau", "mau", "ru", "nru"]
    part = lambda df, **have: df.select(*KEYS, *[have.get(n, F.lit(None)).cast("long").alias(n) for n in names], F.lit("dau" in have).alias("active"))
    dau = maps.groupBy(*KEYS).agg(owners_in("bits").alias("c"))
    anchors = F.explode(F.sequence(F.date_sub("bdate", WAU_DAYS - 1), F.col("bdate"))).alias("bdate")
    week = maps.select("timezone_type", anchors, "bucket", "bits").groupBy(*KEYS, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    wau = week.groupBy(*KEYS).agg(owners_in("bits").alias("c"))
    month = maps.groupBy("timezone_type", F.trunc("bdate", "month").alias("month"), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    month = month.groupBy("timezone_type", "month").agg(owners_in("bits").alias("c"))
    days = F.explode(F.sequence(F.col("month"), F.last_day("month"))).alias("bdate")
    # one row per day in a window, so it is as long as the calendar
    seen = Window.partitionBy("timezone_type", "bucket").orderBy("bdate").rowsBetween(Window.unboundedPreceding, 0)
    grown = maps.select(*KEYS, "bucket", F.bitmap_count(F.bitmap_or_agg("bits").over(seen)).alias("ever"))
    before = F.lag("ever", 1, 0).over(Window.partitionBy("timezone_type", "bucket").orderBy("bdate"))
    nru = grown.select(*KEYS, (F.col("ever") - before).alias("new")).groupBy(*KEYS).agg(F.sum("new").alias("c"))
    rows = union_by_name(
        part(dau, dau=F.col("c")), part(wau, wau=F.col("c")), part(month.select("timezone_type", days, "c"), mau=F.col("c")), part(nru, nru=F.col("c"))
    )
    out = rows.groupBy(*KEYS).agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names if n != "ru"], F.max("active").alias("active")).filter("active")
    running = Window.partitionBy("timezone_type").orderBy("bdate").rowsBetween(Window.unboundedPreceding, 0)
    return out.select(*KEYS, "dau", "wau", "mau", F.sum("nru").over(running).alias("ru"), "nru")
