"""Content reconciliation and co-bucketed landings."""

import datetime as dt

from pyspark.sql import functions as F

from martforge.operators.enrich import remove_matched
from martforge.quality.content import differing_buckets, key_differences, _marked
from martforge.session import shared_dir
from martforge.sinks.buckets import write_bucketed

DAY = dt.date(2024, 1, 1)


def table(spark, rows):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d) if d is not None else None, *r) for d, *r in rows], "d date, k long, p string, v string, w int")


def found(source, landed, **options):
    return sorted((str(r["k"]), str(r["p"]), r["difference"]) for r in key_differences(source, landed, "d", ["k", "p"], ["v", "w"], **options).collect())


BASE = [(i % 3, i, "p", f"v{i}", i) for i in range(200)]


def test_equal_tables_have_no_open_bucket(spark):
    a, b = table(spark, BASE), table(spark, list(reversed(BASE)))
    assert found(a, b) == [] and found(a.limit(0), b.limit(0)) == []
    marked = [_marked(t, "d", ["k", "p"], ["v", "w"], 16, s) for t, s in ((a, 1), (b.repartition(5), -1))]
    assert differing_buckets(*marked).count() == 0


def test_each_kind_of_difference_is_named(spark):
    other = [r for r in BASE if r[1] not in (7, 8)] + [(1, 900, "p", "new", 1)]
    other = [(0, *r[1:]) if r[1] == 11 else (*r[:3], "other", r[4]) if r[1] == 20 else (*r[:3], None, r[4]) if r[1] == 21 else r for r in other]
    want = [("11", "p", "changed"), ("20", "p", "changed"), ("21", "p", "changed"), ("7", "p", "lost"), ("8", "p", "lost"), ("900", "p", "extra")]
    for buckets in (1, 7, 256):
        assert found(table(spark, BASE), table(spark, other), buckets=buckets) == want


def test_nulls_repeats_and_equal_counts(spark):
    a = [(None, 1, None, None, None), (0, None, "p", "x", 1), (0, 2, "p", "x", 1), (0, 2, "p", "x", 1), (0, 3, "p", None, 1), (0, 4, "p", "1", None)]
    b = [(None, 1, None, None, None), (0, None, "p", "y", 1), (0, 2, "p", "x", 1), (0, 3, "p", "x", 1), (0, 4, "p", None, 1), (0, 9, "p", "x", 1)]
    want = [("2", "p", "changed"), ("3", "p", "changed"), ("4", "p", "changed"), ("9", "p", "extra"), ("None", "p", "changed")]
    assert found(table(spark, a), table(spark, b)) == want
    assert found(table(spark, a), table(spark, a)) == []


def test_only_open_buckets_are_shuffled(spark):
    """The rows that are compared key by key are those of the buckets that differ."""
    other = [(*r[:3], "other", r[4]) if r[1] == 20 else r for r in BASE]
    left, right = (_marked(table(spark, rows), "d", ["k", "p"], ["v", "w"], 64, s) for rows, s in ((BASE, 1), (other, -1)))
    assert differing_buckets(left, right).count() == 1
    plan = key_differences(table(spark, BASE), table(spark, other), "d", ["k", "p"], ["v", "w"])._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and plan.count("LeftSemi") == 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    root = shared_dir(spark, "buckets")
    tag = "t_b_" + root.rsplit("/", 1)[-1]
    rows = spark.range(500).selectExpr("id AS order_id", "'p' || (id % 5) AS pair_address", "id * 2 AS x")
    live = write_bucketed(rows, f"{tag}_live", f"{root}/live", ["order_id", "pair_address"], 4)
    done = write_bucketed(rows.filter("order_id % 3 = 0"), f"{tag}_done", f"{root}/done", ["order_id", "pair_address"], 4)
    assert live.columns == rows.columns and live.count() == 500
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = remove_matched(live, done, ["order_id", "pair_address"])
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "Exchange" not in plan
        plain = remove_matched(rows, rows.filter("order_id % 3 = 0"), ["order_id", "pair_address"])
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sorted(r["order_id"] for r in left.collect()) == [i for i in range(500) if i % 3]
    files = {r[0] for r in live.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 4  # one file for each bucket
    again = write_bucketed(rows.limit(3), f"{tag}_live", f"{root}/live", ["order_id", "pair_address"], 4)
    assert again.count() == 3
