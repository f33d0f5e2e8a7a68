"""Backfill of missed daily batches in one landing and one mart job.

N missed days would be N batches, each with its own landing, counts, publishes and ledger rows, whose cost
is mostly that of starting jobs. Here the days are landed together, counted per day in one job, built
together and published by day partition, and the ledger gets one row per day and table, as if the
batches had run one by one. A day whose landing does not reconcile fails alone: it and the days whose
mart reads it keep what the mart held and get status 0; the others are published.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.timeslice import DateLike, as_date, shift_days
from martforge.plans import marts
from martforge.sinks import writes
from martforge.sources.partitions import read_days, read_landed_for_zones
from martforge.sources.scans import DatasetSpec, land


def missed_days(ledger: DataFrame | None, schema: str, table: str, first: DateLike, end: DateLike) -> list[_dt.date]:
    """Days of ``[first, end)`` that have no batch whose last attempt succeeded (one ledger row per day at most is read back)."""
    days = [as_date(first) + _dt.timedelta(days=k) for k in range((as_date(end) - as_date(first)).days)]
    if ledger is None:
        return days
    mine = ledger.filter((F.col("schema_name") == schema) & (F.col("table_name") == table) & F.col("start_date").between(days[0].isoformat(), days[-1].isoformat()))
    # the last attempt of the last batch; of one attempt a failure counts
    last = mine.groupBy("start_date").agg(F.max_by("status", F.struct("batch_ts", "attempt", -F.col("status"))).alias("status"))
    done = {r["start_date"] for r in last.filter("status = 1").collect()}
    return [d for d in days if d.isoformat() not in done]


def differing_days(source: DataFrame, landed: DataFrame, day: str = "dt_utc") -> list[_dt.date]:
    """Days whose row counts are not the same in source and landing; one aggregate over both."""
    sides = [df.groupBy(F.col(day).cast("date").alias("day")).agg((F.count("*") * sign).alias("n")) for df, sign in ((source, 1), (landed, -1))]
    wrong = sides[0].unionByName(sides[1]).groupBy("day").agg(F.sum("n").alias("n")).filter("n != 0")
    return sorted(r["day"] for r in wrong.collect())  # days of the backfill at most


def run_stats_backfill(
    spark: SparkSession,
    stats: DataFrame,
    spec: DatasetSpec,
    days: Sequence[_dt.date],
    root: str,
    batch_ts_of: Callable[[_dt.date], _dt.datetime],
    tie_cols: tuple[str, ...] = ("ts_utc",),
    landed_check: Callable[[DataFrame, DataFrame], list[_dt.date]] = differing_days,
) -> Mapping[str, object]:
    """Chain stats (D10) of the missed ``days``, landed and built together.

    ``batch_ts_of`` gives the stamp that a day's own batch would have had. ``landed_check(source, landed)``
    names the days that must not be published. A day's mart reads the days before (KST) and after it (I3), so
    a bad day takes its neighbours with it. Days need not be neighbours; only they are written, and
    published days that follow one of them.
    """
    days = sorted(set(days))
    ledger = f"{root}/etl_status"
    path = writes.table_path(root, spec.service, "dl", spec.name)
    mart = writes.table_path(root, "bridge", "dw", "chain_stats_d")
    if not days:
        return {spec.name: path, "chain_stats_d": mart, "failed": []}
    # each day and the one after it, as the day's own batch would land them
    wanted = sorted({d for day in days for d in (day, shift_days(day, 1))})
    first, end = wanted[0], shift_days(wanted[-1], 1)
    rows = land(stats, spec, first, end).filter(F.col("dt_utc").isin(wanted))

    def job(schema, layer, table, day, until):
        return writes.JobInfo(schema, layer, table, day, until, batch_ts_of(day))

    landings = {d: job(spec.service, "dl", spec.name, d, shift_days(d, 2)) for d in days}
    marts_of = {d: job("bridge", "dw", "chain_stats_d", d, shift_days(d, 1)) for d in days}
    attempts = {(kind, d): writes.claim_attempt(spark, ledger, j) for kind, jobs in (("dl", landings), ("dw", marts_of)) for d, j in jobs.items()}
    try:
        _replace(rows, path, "dt_utc", wanted)
        seen = read_days(spark, path, first, end).filter(F.col("dt_utc").isin(wanted)) if writes.path_exists(spark, path) else rows.limit(0)
        bad = set(landed_check(rows, seen))
        failed = [d for d in days if bad & {shift_days(d, -1), d, shift_days(d, 1)}]
        good = [d for d in days if d not in failed]
        # a day that was published before the day that its KST part reads was there is built again
        there = {n.split("=", 1)[1] for n in writes.folder_names(spark, mart)}
        build = sorted({*good, *(n for d in good if (n := shift_days(d, 1)) not in days and n.isoformat() in there)})
        if build:
            picked = marts.chain_stats_daily(read_landed_for_zones(spark, path, build[0], shift_days(build[-1], 2)), build[0], shift_days(build[-1], 1), tie_cols)
            _replace(picked.filter(F.col("bdate").isin(build)), mart, "bdate", build)
    except Exception:
        writes.ledger_append_all(spark, ledger, [(j, 0, attempts[k, d], ()) for k, jobs in (("dl", landings), ("dw", marts_of)) for d, j in jobs.items()])
        raise
    done = [(landings[d], 0 if d in bad or shift_days(d, 1) in bad else 1, attempts["dl", d], ()) for d in days]
    done += [(marts_of[d], 0 if d in failed else 1, attempts["dw", d], ()) for d in days]
    writes.ledger_append_all(spark, ledger, done)
    return {spec.name: path, "chain_stats_d": mart, "failed": failed}


def _replace(df: DataFrame, path: str, column: str, days: Sequence[_dt.date]) -> None:
    """Replace these days of a table, also those without rows; days between them are left alone."""
    spark = df.sparkSession
    runs: list[list[_dt.date]] = []
    for d in days:
        if runs and d == shift_days(runs[-1][-1], 1):
            runs[-1].append(d)
        else:
            runs.append([d])
    before = {d: f for run in runs for d, f in writes.files_of_days(spark, path, column, run[0], shift_days(run[-1], 1)).items()}
    writes.replace_partitions(df, path, [column])
    after = {d: f for run in runs for d, f in writes.files_of_days(spark, path, column, run[0], shift_days(run[-1], 1)).items()} if before else {}
    for d, files in before.items():
        if files and after.get(d) == files:
            fs, where = writes.file_system(spark, f"{path}/{column}={d}")
            fs.delete(where, True)
