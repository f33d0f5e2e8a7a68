"""Publishes by location switch, and slices that empty days."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martforge.session import shared_dir
from martforge.sinks import versions as V
from martforge.sinks import writes as W


def rows(spark, days, tag):
    return spark.createDataFrame([(dt.date(2024, 1, d), tag, d) for d in days], "bdate date, tag string, v int")


def seen(df):
    return sorted((r["bdate"].day, r["tag"]) for r in df.collect())


def place(spark):
    path = shared_dir(spark, "versions", "t")
    return path, "t_v_" + path.rsplit("/", 1)[-1]


def folders(path):
    return sorted(n for n in os.listdir(path.removeprefix("file:")) if n.startswith("v"))


@pytest.mark.parametrize("cols", [(), ("bdate",)])
def test_a_reader_between_publishes_sees_a_whole_table(spark, cols):
    path, name = place(spark)
    assert V.current_version(spark, name, path) is None and V.retire(spark, name, path) == []
    V.publish_version(rows(spark, [1, 2, 3], "a"), name, path, cols)
    begun = spark.table(name)
    begun.count()  # planned on the first version
    second = V.publish_version(rows(spark, [2], "b"), name, path, cols)
    assert seen(begun) == [(1, "a"), (2, "a"), (3, "a")] and seen(spark.table(name)) == [(2, "b")]
    assert second.endswith(V.current_version(spark, name, path))
    V.publish_version(rows(spark, [4, 5], "c"), name, path, cols)
    assert seen(spark.table(name)) == [(4, "c"), (5, "c")]
    assert len(folders(path)) == 2  # the current one and the one before


@pytest.mark.parametrize("cols", [(), ("bdate",)])
def test_a_failing_load_leaves_the_old_version(spark, cols):
    path, name = place(spark)
    V.publish_version(rows(spark, [1], "a"), name, path, cols)
    with pytest.raises(Exception):
        V.publish_version(rows(spark, [1], "b").withColumn("v", F.raise_error(F.lit("boom")).cast("int")), name, path, cols)
    assert seen(spark.table(name)) == [(1, "a")] and len(folders(path)) == 1
    V.publish_version(rows(spark, [3], "c"), name, path, cols)
    assert seen(spark.table(name)) == [(3, "c")]


@pytest.mark.parametrize("cols", [(), ("bdate",)])
def test_a_run_that_dies_before_the_switch(spark, cols, monkeypatch):
    path, name = place(spark)
    V.publish_version(rows(spark, [1], "a"), name, path, cols)
    sql = type(spark).sql

    def dies(self, text, *a, **k):
        if text.startswith(("ALTER TABLE", "CREATE OR REPLACE VIEW")):
            raise OSError("lost")
        return sql(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", dies)
    with pytest.raises(OSError):
        V.publish_version(rows(spark, [2], "b"), name, path, cols)
    monkeypatch.setattr(type(spark), "sql", sql)
    assert seen(spark.table(name)) == [(1, "a")]
    V.publish_version(rows(spark, [3], "c"), name, path, cols, keep=1)
    assert seen(spark.table(name)) == [(3, "c")] and len(folders(path)) == 1


def test_partitions_of_a_version_are_pruned(spark):
    path, name = place(spark)
    V.publish_version(rows(spark, [1, 2, 3], "a"), name, path, ["bdate"])
    plan = spark.table(name).filter("bdate = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bdate" in plan
    assert seen(spark.table(name).filter("bdate = DATE'2024-01-02'")) == [(2, "a")]


def test_empty_versions_and_other_tables(spark):
    path, name = place(spark)
    V.publish_version(rows(spark, [], "a"), name, path, ["bdate"])
    assert spark.table(name).count() == 0
    with pytest.raises(ValueError):
        V.publish_version(rows(spark, [1], "a"), name, path, keep=0)
    spark.range(1).write.saveAsTable(name + "_plain", path=path + "_plain")
    with pytest.raises(ValueError):
        V.publish_version(rows(spark, [1], "a"), name + "_plain", path)


def slice_job(hour):
    return W.JobInfo("sch", "dm", "x_d", "2024-01-02", "2024-01-05", dt.datetime(2024, 1, 5, hour))


def test_a_rerun_that_empties_days(spark):
    root = shared_dir(spark, "emptied")
    ledger, name = f"{root}/etl_status", "t_e_" + root.rsplit("/", 1)[-1]
    put = lambda df, hour: W.publish(spark, df, slice_job(hour), root, ledger, catalog_name=name, drop_empty=True)
    path = W.table_path(root, "sch", "dm", "x_d")
    W.replace_partitions(rows(spark, [1, 5], "old"), path, ["bdate"])  # days outside the slice
    put(rows(spark, [2, 3, 4], "a"), 1)
    put(rows(spark, [3], "b"), 2)
    assert seen(spark.table(name)) == [(1, "old"), (3, "b"), (5, "old")] or seen(spark.table(name)) == [(3, "b")]
    assert seen(spark.read.parquet(path)) == [(1, "old"), (3, "b"), (5, "old")]
    put(rows(spark, [3], "c"), 3)  # nothing left to empty
    put(rows(spark, [], "d"), 4)
    assert seen(spark.read.parquet(path)) == [(1, "old"), (5, "old")]
    said = {r["batch_ts"][11:13]: r["emptied_days"] for r in spark.read.parquet(ledger).collect()}
    assert said == {"01": None, "02": "2024-01-02,2024-01-04", "03": None, "04": "2024-01-03"}
    shown = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert not shown & {"bdate=2024-01-02", "bdate=2024-01-03", "bdate=2024-01-04"}


def test_a_run_that_dies_before_it_empties_a_day(spark, monkeypatch):
    root = shared_dir(spark, "emptied")
    path = f"{root}/x"
    W.replace_days(rows(spark, [2, 3], "a"), path, "bdate", "2024-01-01", "2024-01-09")
    W.replace_partitions(rows(spark, [3], "b"), path, ["bdate"])  # as far as the run came
    assert W.replace_days(rows(spark, [3], "b"), path, "bdate", "2024-01-01", "2024-01-09") == ["2024-01-02"]
    assert seen(spark.read.parquet(path)) == [(3, "b")]


def test_a_replace_that_died_between_its_renames_is_mended(spark):
    path = shared_dir(spark, "mended", "t")
    W.replace_table(rows(spark, [1], "a"), path)
    here = path.removeprefix("file:")
    os.rename(here, here + "__old_123")
    assert W.recover_table(spark, path) and not W.recover_table(spark, path)
    W.replace_table(rows(spark, [2], "b"), path)
    assert seen(spark.read.parquet(path)) == [(2, "b")]
