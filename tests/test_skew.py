"""A key holding a third of all rows: results stay whole and equal, and AQE
splits the hot key when the dimension is too big to broadcast."""

from pyspark.sql import functions as F

from martforge.operators.enrich import attach_role

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def facts(spark, n=30000):
    # one pair ("hot") gets a third of all rows
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 997).cast("string"))).alias("pair_address"),
        (F.col("id") % 100).cast("decimal(12,2)").alias("amount"),
    )


def dim(spark):
    keys = spark.range(997).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("pair_address"))
    keys = keys.unionByName(spark.createDataFrame([("hot",)], "pair_address string"))
    return keys.select("pair_address", F.upper("pair_address").alias("pair_name"))


def run(spark):
    joined = attach_role(facts(spark), dim(spark), [("pair_address", "pair_address")], {"pair_name": "pair_name"}, "pair")
    return joined.groupBy("pair_name").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


def test_hot_key_split_and_equal(spark):
    expected = sorted(tuple(r) for r in run(spark).collect())
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        joined = attach_role(facts(spark), dim(spark), [("pair_address", "pair_address")], {"pair_name": "pair_name"}, "pair")
        assert len(joined.collect()) == 30000  # whole result, no row dropped
        plan = joined._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in run(spark).collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert got == expected
    assert dict((r[0], r[1]) for r in got)["HOT"] == 10000
