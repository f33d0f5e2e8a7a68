import datetime as dt
import json

import pytest

from martforge.plans import landing
from martforge.session import shared_dir
from martforge.sources.scans import DatasetSpec
from martforge.streaming.incremental import land_available


def test_api_landings(spark):
    root = shared_dir(spark, "land")
    pages = spark.createDataFrame([(json.dumps({"items": [{"address": "0xA", "decimals": "6", "icon_url": "i"}]}),)], "payload string")
    led, at = f"{root}/led", dt.datetime(2024, 1, 1, 12)
    p = landing.land_token_list(spark, pages, root, led, at, layer="dim")
    assert spark.read.parquet(p).first()["decimals"] == 6 and "/dim/dim_token" in p
    landing.land_token_list(spark, pages, root, led, at, layer="dim")  # full replace, not doubled
    assert spark.read.parquet(p).count() == 1
    stats = spark.createDataFrame([(json.dumps({"total_blocks": 5, "gas_prices": {"fast": 2}}),)], "payload string")
    sp = landing.land_chain_stats(spark, stats, at, root, led)
    landing.land_chain_stats(spark, stats, dt.datetime(2024, 1, 2, 12), root, led)  # append
    got = sorted((r["dt_utc"], r["total_blocks"]) for r in spark.read.parquet(sp).collect())
    assert got == [(dt.date(2024, 1, 1), 5), (dt.date(2024, 1, 2), 5)]
    cp = landing.land_contracts(spark, spark.createDataFrame(
        [(json.dumps({"items": [{"address": {"hash": "0xAB", "name": "n"}, "verified_at": "x"}]}),)], "payload string"), root, led, at)
    assert spark.read.parquet(cp).first()["address"] == "0xab"
    assert spark.read.parquet(landing.land_chains(spark, root, led, at)).count() == 6
    assert spark.read.parquet(led).filter("status = 1").count() == 6
    broken = spark.createDataFrame([("oops",)], "payload string")
    with pytest.raises(Exception):
        landing.land_token_list(spark, broken, root, led, dt.datetime(2024, 1, 3), layer="dim")
    assert spark.read.parquet(p).count() == 1  # a broken load leaves the table
    assert spark.read.parquet(led).filter("status = 0").count() == 1


def test_land_table_snapshot_replaces_whole_table(spark):
    root = shared_dir(spark, "land")
    spec = DatasetSpec("svc", "snap", "t", mode="overwrite", select=("id", "t"))
    src1 = spark.createDataFrame([(1, 1704067200), (2, 1704153600)], "id long, t long")
    src2 = spark.createDataFrame([(1, 1704153600)], "id long, t long")  # row 1 moved to another day
    p = landing.land_table(spark, src1, spec, "2024-01-01", "2024-01-03", root, f"{root}/led", dt.datetime(2024, 1, 3))
    landing.land_table(spark, src2, spec, "2024-01-01", "2024-01-03", root, f"{root}/led", dt.datetime(2024, 1, 4))
    assert [(r["id"], r["dt_utc"]) for r in spark.read.parquet(p).collect()] == [(1, dt.date(2024, 1, 2))]


def test_stream_landing_is_incremental_and_exactly_once(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "event_id long, ts timestamp_ntz"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 20, 0))], schema).write.mode("append").parquet(src)
    spec = DatasetSpec("e", "e", "ts", time_kind="timestamp", select=("event_id", "ts"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    st = spark.read.parquet(src).schema
    land_available(spark, src, st, spec, out, ck)
    land_available(spark, src, st, spec, out, ck)  # nothing new: no duplicate
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0]["dt_kst"] == dt.date(2024, 1, 2)
    # a file arriving later is picked up, and only that file
    spark.createDataFrame([(2, dt.datetime(2024, 1, 2, 1, 0))], schema).write.mode("append").parquet(src)
    land_available(spark, src, st, spec, out, ck)
    got = sorted((r["event_id"], r["dt_utc"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))]
