import datetime as dt

import pytest
from pyspark.sql import functions as F

from martforge.quality.checks import latest_status
from martforge.session import shared_dir
from martforge.sinks import writes


def mart(spark, days, tag):
    rows = [(dt.date(2024, 1, d), tag, d * 10) for d in days]
    return spark.createDataFrame(rows, "bdate date, tag string, v int")


def read(spark, path):
    return sorted((r["bdate"], r["tag"]) for r in spark.read.parquet(path).collect())


def test_partition_replace_is_idempotent_and_keeps_untouched(spark):
    path = shared_dir(spark, "t", "dm_x_d")
    writes.replace_partitions(mart(spark, [1, 2, 3], "run1"), path, ["bdate"])
    writes.replace_partitions(mart(spark, [2, 3], "run2"), path, ["bdate"])
    writes.replace_partitions(mart(spark, [2, 3], "run2"), path, ["bdate"])  # rerun: same state
    assert read(spark, path) == [(dt.date(2024, 1, 1), "run1"), (dt.date(2024, 1, 2), "run2"), (dt.date(2024, 1, 3), "run2")]
    writes.replace_partitions(mart(spark, [], "run3"), path, ["bdate"])  # zero rows: untouched
    assert len(read(spark, path)) == 3


def test_static_overwrite_and_append(spark):
    path = shared_dir(spark, "t", "dm_y_d")
    writes.replace_table(mart(spark, [1, 2], "a"), path, ["bdate"])
    writes.replace_table(mart(spark, [2], "b"), path, ["bdate"])
    assert read(spark, path) == [(dt.date(2024, 1, 2), "b")]
    apath = shared_dir(spark, "t", "dl_z")
    writes.append_rows(mart(spark, [1], "a").withColumn("dt_utc", F.col("bdate")), apath, "z")
    writes.append_rows(mart(spark, [1], "b").withColumn("dt_utc", F.col("bdate")), apath, "z")
    assert spark.read.parquet(apath).count() == 2


def test_path_and_partition_rules():
    assert writes.table_path("/data/", "dex", "dl", "fee_collectors t1 left join x") == "/data/results/dex/dl/dl_fee_collectors"
    assert writes.default_partitions("trade_d", None) == ["bdate"]
    assert writes.default_partitions("match_histories", None) == ["dt_utc"]
    assert writes.default_partitions("pair_infos", []) == []


def test_publish_ledger_and_failure(spark):
    root = shared_dir(spark, "pub")
    ledger = f"{root}/etl_status"
    job = writes.JobInfo("sch", "dm", "x_d", "2024-01-01", "2024-01-02", dt.datetime(2024, 1, 2, 1, 0, 0))
    name = "t_pub_" + root.rsplit("/", 1)[-1]
    writes.publish(spark, mart(spark, [1], "a"), job, root, ledger, catalog_name=name)
    assert spark.table(name).count() == 1
    bad = mart(spark, [1], "a").withColumn("v", F.raise_error(F.lit("boom")))
    job2 = writes.JobInfo("sch", "dm", "x_d", "2024-01-01", "2024-01-02", dt.datetime(2024, 1, 2, 2, 0, 0))
    with pytest.raises(Exception):
        writes.publish(spark, bad, job2, root, ledger)
    led = spark.read.parquet(ledger)
    assert sorted(r["status"] for r in led.collect()) == [0, 1]
    last = latest_status(led).first()
    assert last["status"] == 0 and last["batch_ts"] == "2024-01-02 02:00:00"
    assert writes.publish(spark, mart(spark, [], "a"), job, root, ledger, skip_empty=True).endswith("dm_x_d")


def test_failed_registration_is_a_failed_publish(spark):
    root = shared_dir(spark, "pub")
    ledger = f"{root}/etl_status"
    job = writes.JobInfo("sch", "dm", "x_d", "2024-01-01", "2024-01-02", dt.datetime(2024, 1, 2, 1, 0, 0))
    with pytest.raises(Exception):
        writes.publish(spark, mart(spark, [1], "a"), job, root, ledger, catalog_name="no_such_schema.x")
    assert [(r["status"], r["attempt"]) for r in spark.read.parquet(ledger).collect()] == [(0, 1)]
    writes.publish(spark, mart(spark, [1], "a"), job, root, ledger)
    last = latest_status(spark.read.parquet(ledger)).first()
    assert (last["status"], last["attempt"]) == (1, 2)
