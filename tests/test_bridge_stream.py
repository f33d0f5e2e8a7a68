"""The bridge marts as a stream: late updates, restarts, touched days."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from martforge.plans import bindings as B
from martforge.plans import marts
from martforge.plans.queries import EV_END, EV_START, landed_prices, landed_transfers, transfer_versions
from martforge.session import shared_dir
from martforge.streaming import bridge as S

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def dims(spark):
    tokens = B.tokens(spark, SF)
    return marts.midnight_price(landed_prices(spark, SF), tokens, EV_START, EV_END), B.chains(spark, SF), tokens


def stream(spark, root, arrivals, dims, **options):
    told = []
    for arrival in arrivals:
        arrival.write.mode("append").parquet(f"{root}/arrivals")
        S.run_bridge_stream(spark, f"{root}/arrivals", arrival.schema, B.TRANSFERS_SPEC, root, *dims, seen=lambda n, days: told.append((n, days)), **options)
    return told


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def daily(spark, root):
    return spark.read.parquet(f"{root}/bridge_d").filter((F.col("bdate") >= F.lit(EV_START)) & (F.col("bdate") < F.lit(EV_END)))


def direct(spark, dims):
    details = marts.bridge_details(landed_transfers(spark, SF), dims[1], dims[2], EV_START, EV_END)
    return marts.bridge_daily(details, dims[0], dims[2], EV_START, EV_END)


def test_a_restart_repeats_the_micro_batch_that_died(spark, dims, monkeypatch):
    root = shared_dir(spark, "stream")
    first, second = transfer_versions(spark, SF)
    stream(spark, root, [first], dims)
    whole = S.refresh_marts
    monkeypatch.setattr(S, "refresh_marts", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception):
        stream(spark, root, [second], dims)  # landed, but the marts were not built
    monkeypatch.setattr(S, "refresh_marts", whole)
    told = stream(spark, root, [second.limit(0)], dims, max_files_per_trigger=1)
    assert told and rows(daily(spark, root)) == rows(direct(spark, dims))
    landed = spark.read.parquet(f"{root}/history").drop("version")
    assert rows(landed) == rows(landed_transfers(spark, SF))
    assert stream(spark, root, [], dims) == []


def test_a_late_update_rewrites_its_days_only(spark, dims):
    root = shared_dir(spark, "stream")
    first, _ = transfer_versions(spark, SF)
    stream(spark, root, [first], dims)
    days = sorted(os.path.basename(p) for p in glob.glob(f"{root.removeprefix('file:')}/bridge_d/bdate=*"))
    files = lambda table, day: set(glob.glob(f"{root.removeprefix('file:')}/{table}/*={day}/*.parquet"))
    before = {(t, d.split("=")[1]): files(t, d.split("=")[1]) for t in ("history", "bridge_details", "bridge_d") for d in days}
    late = first.filter("version = 1 AND status = 0").orderBy("_id").limit(1).withColumn("status", F.lit(1)).withColumn("version", F.lit(5))
    late = spark.createDataFrame(late.collect(), first.schema)
    day = dt.datetime.fromtimestamp(late.first()["initiated_time"], dt.timezone.utc).date()
    [(_, reported)] = stream(spark, root, [late], dims)
    assert reported == [day, day + dt.timedelta(days=1)]
    for (table, d), old in before.items():
        fresh = d in {str(x) for x in (reported if table == "bridge_d" else [day])}
        assert (files(table, d) != old) == (fresh and bool(old)), (table, d)
    one = spark.read.parquet(f"{root}/history").filter(F.col("_id") == late.first()["_id"]).collect()
    assert [(r["version"], r["status"]) for r in one] == [(5, 1)]


def test_older_versions_change_nothing(spark, dims):
    root = shared_dir(spark, "stream")
    first, second = transfer_versions(spark, SF)
    stream(spark, root, [second, first], dims)  # the older versions arrive last
    assert rows(daily(spark, root)) == rows(direct(spark, dims))


def test_latest_versions(spark):
    kind = "k long, version int, x string, y long"
    got = S.latest_versions(spark.createDataFrame([(1, 1, "a", 1), (1, 2, None, 2), (2, 1, "b", 3), (2, 1, "c", None), (None, 1, "n", 1)], kind), ["k"], "version")
    assert got.columns == ["k", "version", "x", "y"]
    assert sorted(map(str, map(tuple, got.collect()))) == ["(1, 2, None, 2)", "(2, 1, 'c', None)", "(None, 1, 'n', 1)"]
    assert S.latest_versions(spark.createDataFrame([], kind), ["k"], "version").collect() == []
