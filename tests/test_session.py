import datetime as dt

import pytest

from martforge.session import checkpoint_root, materialize, shared_dir
from martforge.sinks import writes


def test_materialize_cuts_lineage_in_the_shared_folder(spark):
    df = materialize(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert df.count() == 10 and checkpoint_root(spark)
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_only_touched_days_are_registered(spark):
    path = shared_dir(spark, "reg_days")
    rows = [(dt.date(2024, 1, d), d) for d in (1, 2, 5)]
    writes.replace_table(spark.createDataFrame(rows, "dt_utc date, v int"), path, ["dt_utc"])
    name = "t_days_" + path.rsplit("/", 1)[-1]
    writes.register_table(spark, name, path, days=("dt_utc", "2024-01-02", "2024-01-04"))
    assert [r["v"] for r in spark.table(name).collect()] == [2]
    writes.register_table(spark, name, path)
    assert spark.table(name).count() == 3
    writes.replace_table(spark.createDataFrame(rows[:1], "dt_utc date, v int"), path, ["dt_utc"])
    writes.register_table(spark, name, path)  # partitions that went are dropped
    assert [r["v"] for r in spark.table(name).collect()] == [1]


def test_register_unpartitioned_table(spark):
    path = shared_dir(spark, "reg")
    spark.range(3).write.parquet(path)
    name = "t_reg_" + path.rsplit("/", 1)[-1]
    writes.register_table(spark, name, path)
    writes.register_table(spark, name, path)  # idempotent
    assert spark.table(name).count() == 3


def test_declared_schemas_match_files(spark):
    import os

    from martforge.plans.bindings import TABLE_SCHEMAS, table

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        if not os.path.isdir(sf):
            continue
        for name in TABLE_SCHEMAS:
            declared = [(f.name, f.dataType) for f in table(spark, sf, name).schema.fields]
            inferred = [(f.name, f.dataType) for f in spark.read.parquet(f"{sf}/{name}.parquet").schema.fields]
            assert declared == inferred, (sf, name)
