"""Backfill of missed days, claimed attempts and ledger compaction."""

import datetime as dt
import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from martforge.plans import backfill as BF
from martforge.plans import bindings as B
from martforge.plans.daily import run_stats_day
from martforge.plans.queries import EV_START
from martforge.quality.checks import latest_status
from martforge.session import shared_dir
from martforge.sinks import writes as W

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
DAYS = [EV_START + dt.timedelta(days=k) for k in range(5)]
TIES = ("ts_utc", "event_id")


def stamp(day):
    return dt.datetime.combine(day + dt.timedelta(days=1), dt.time(1))


def backfilled(spark, days, root, stats=None, **options):
    stats = B.stat_rows(spark, SF) if stats is None else stats
    return BF.run_stats_backfill(spark, stats, B.STATS_SPEC, days, root, stamp, TIES, **options)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def ledger_of(spark, root):
    led = spark.read.schema(W.LEDGER_SCHEMA).parquet(f"{root}/etl_status")
    return {(r["table_name"], r["start_date"], r["end_date"], r["batch_ts"], r["attempt"]): r["status"] for r in led.collect()}


def test_a_backfill_equals_daily_batches(spark):
    one, many = shared_dir(spark, "backfill"), shared_dir(spark, "backfill")
    out = backfilled(spark, DAYS, one)
    for d in DAYS:
        daily = run_stats_day(spark, B.stat_rows(spark, SF), B.STATS_SPEC, d, d + dt.timedelta(days=1), many, stamp(d), TIES)
    for name in ("chain_stats", "chain_stats_d"):
        assert rows(spark.read.parquet(out[name])) == rows(spark.read.parquet(daily[name]))
    assert out["failed"] == [] and ledger_of(spark, one) == ledger_of(spark, many)
    assert BF.missed_days(spark.read.parquet(f"{one}/etl_status"), "bridge", "chain_stats_d", DAYS[0], DAYS[-1] + dt.timedelta(days=3)) == [
        DAYS[-1] + dt.timedelta(days=k) for k in (1, 2)
    ]


def test_only_missed_days_and_what_reads_them_are_written(spark):
    root = shared_dir(spark, "backfill")
    backfilled(spark, [DAYS[0], DAYS[4]], root)
    files = lambda d: set(glob.glob(f"{root.removeprefix('file:')}/results/bridge/dw/dw_chain_stats_d/bdate={d}/*.parquet"))
    before = {d: files(d) for d in (DAYS[0], DAYS[4])}
    missed = BF.missed_days(spark.read.parquet(f"{root}/etl_status"), "bridge", "chain_stats_d", DAYS[0], DAYS[4] + dt.timedelta(days=1))
    assert missed == DAYS[1:4]
    out = backfilled(spark, missed, root)
    assert files(DAYS[0]) == before[DAYS[0]] and files(DAYS[4]) != before[DAYS[4]]  # its KST day starts on the day before
    whole = backfilled(spark, DAYS, shared_dir(spark, "backfill"))
    assert rows(spark.read.parquet(out["chain_stats_d"])) == rows(spark.read.parquet(whole["chain_stats_d"]))
    assert backfilled(spark, [], root)["failed"] == []


def test_a_failing_day_is_isolated(spark):
    root = shared_dir(spark, "backfill")
    check = lambda a, b: BF.differing_days(a, b.filter(~((F.col("dt_utc") == F.lit(DAYS[4])) & (F.col("event_id") % 2 == 0))))
    out = backfilled(spark, DAYS, root, landed_check=check)
    assert out["failed"] == [DAYS[3], DAYS[4]]  # the day before reads it, and so would the day after
    assert {r["bdate"] for r in spark.read.parquet(out["chain_stats_d"]).collect()} == set(DAYS[:3])
    status = {k[1]: v for k, v in ledger_of(spark, root).items() if k[0] == "chain_stats_d"}
    assert status == {d.isoformat(): int(d in DAYS[:3]) for d in DAYS}
    missed = BF.missed_days(spark.read.parquet(f"{root}/etl_status"), "bridge", "chain_stats_d", DAYS[0], DAYS[-1] + dt.timedelta(days=1))
    assert missed == DAYS[3:]
    again = backfilled(spark, missed, root)
    assert again["failed"] == [] and {r["bdate"] for r in spark.read.parquet(again["chain_stats_d"]).collect()} == set(DAYS)
    attempts = {k[1]: k[4] for k in ledger_of(spark, root) if k[0] == "chain_stats_d" and k[4] > 1}
    assert attempts == {d.isoformat(): 2 for d in DAYS[3:]}


def test_a_backfill_that_dies_names_all_its_days(spark):
    root = shared_dir(spark, "backfill")
    broken = B.stat_rows(spark, SF).withColumn("ts", F.when(F.col("event_id") >= 0, F.raise_error(F.lit("boom")).cast("timestamp_ntz")).otherwise(F.col("ts")))
    with pytest.raises(Exception, match="boom"):
        backfilled(spark, DAYS[:2], root, broken)
    assert set(ledger_of(spark, root).values()) == {0} and len(ledger_of(spark, root)) == 4


def job(hour, day=2):
    return W.JobInfo("sch", "dm", "x_d", "2024-01-01", "2024-01-02", dt.datetime(2024, 1, day, hour))


def test_runs_at_once_get_different_attempts(spark):
    ledger = f"{shared_dir(spark, 'claims')}/etl_status"
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: W.claim_attempt(spark, ledger, job(1)), range(24)))
    assert sorted(got) == list(range(1, 25))
    assert W.claim_attempt(spark, ledger, job(2)) == 1  # another batch
    W.ledger_append(spark, ledger, job(3), 0, 7)
    assert W.claim_attempt(spark, ledger, job(3)) == 8  # a ledger from before there were claims
    assert spark.read.schema(W.LEDGER_SCHEMA).parquet(ledger).count() == 1  # claims are no rows


def test_compaction_merges_closed_days_only(spark):
    ledger = f"{shared_dir(spark, 'compact')}/etl_status"
    for day in (2, 3, 4):
        for hour in range(4):
            W.ledger_append(spark, ledger, job(hour, day), hour % 2, W.claim_attempt(spark, ledger, job(hour, day)), ["2024-01-01"] if hour == 3 else [])
    before = rows(spark.read.parquet(ledger))
    count = lambda d: len(glob.glob(f"{ledger.removeprefix('file:')}/batch_bdate=2024-01-0{d}/*.parquet"))
    assert [count(d) for d in (2, 3, 4)] == [4, 4, 4]
    assert W.compact_ledger(spark, ledger, "2024-01-04") == ["2024-01-02", "2024-01-03"]
    assert [count(d) for d in (2, 3, 4)] == [1, 1, 4]
    assert W.compact_ledger(spark, ledger, "2024-01-04") == []
    after = spark.read.parquet(ledger)
    assert rows(after) == before
    assert latest_status(after).first()["batch_ts"] == "2024-01-04 03:00:00"
    assert os.listdir(f"{ledger.removeprefix('file:')}/_claims") == ["2024-01-04"]
    assert W.compact_ledger(spark, f"{ledger}_none", "2024-01-04") == []
