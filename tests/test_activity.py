"""The scalable activity metrics equal the textbook self-join / window forms."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from martforge.operators import activity as A

D = dt.date


def naive(spark, act):
    act.createOrReplaceTempView("act_naive")
    q = {
        "dau": "SELECT timezone_type, bdate, count(DISTINCT owner) AS dau FROM act_naive GROUP BY 1, 2",
        "wau": """SELECT a.timezone_type, a.bdate, count(DISTINCT b.owner) AS wau FROM act_naive a JOIN act_naive b
                  ON a.timezone_type = b.timezone_type AND b.bdate BETWEEN a.bdate AND date_add(a.bdate, 6) GROUP BY 1, 2""",
        "mau": """SELECT a.timezone_type, a.bdate, count(DISTINCT b.owner) AS mau FROM act_naive a JOIN act_naive b
                  ON a.timezone_type = b.timezone_type
                  AND b.bdate BETWEEN date_trunc('month', a.bdate) AND last_day(a.bdate) GROUP BY 1, 2""",
        "nru": """SELECT timezone_type, first_visit AS bdate, count(DISTINCT owner) AS nru FROM
                  (SELECT owner, timezone_type, min(bdate) AS first_visit FROM act_naive GROUP BY 1, 2) GROUP BY 1, 2""",
    }
    out = {k: spark.sql(v) for k, v in q.items()}
    w = Window.partitionBy("timezone_type").orderBy("bdate").rowsBetween(Window.unboundedPreceding, 0)
    out["ru"] = (
        act.withColumn("ru", F.size(F.collect_set("owner").over(w)))
        .groupBy("timezone_type", "bdate")
        .agg(F.max("ru").alias("ru"))
    )
    return out


def sample(spark, n=400, seed=7):
    rnd = random.Random(seed)
    days = [D(2024, 1, 25) + dt.timedelta(days=i) for i in range(45)] + [D(2024, 2, 29), D(2024, 3, 1)]
    rows = set()
    for _ in range(n):
        owner = rnd.choice(["0xa", "0xb", "0xc", "0xd", "0xe", None, "0xhot", "0xhot", "0xhot"])
        rows.add((rnd.choice(["utc", "kst"]), rnd.choice(days), owner))
    return spark.createDataFrame(sorted(rows, key=str), "timezone_type string, bdate date, owner string")


def test_metrics_equal_naive(spark, rows_of):
    act = A.distinct_activity(sample(spark))
    ref = naive(spark, act)
    got = {
        "dau": A.daily_active(act),
        "wau": A.weekly_active(act),
        "mau": A.monthly_active(act),
        "nru": A.new_users(act),
        "ru": A.cumulative_users(act),
    }
    for k in got:
        cols = ["timezone_type", "bdate", k]
        assert rows_of(got[k].select(*cols)) == rows_of(ref[k].select(*cols)), k


def test_wau_is_forward_and_null_only_day_counts_zero(spark):
    rows = [("utc", D(2024, 1, 1), "a"), ("utc", D(2024, 1, 7), "b"), ("utc", D(2024, 1, 8), "c"), ("utc", D(2024, 1, 9), None)]
    act = A.distinct_activity(spark.createDataFrame(rows, "timezone_type string, bdate date, owner string"))
    got = {r["bdate"]: r["wau"] for r in A.weekly_active(act).collect()}
    assert got == {D(2024, 1, 1): 2, D(2024, 1, 7): 2, D(2024, 1, 8): 1, D(2024, 1, 9): 0}


def test_user_summary_spine(spark):
    act = A.distinct_activity(sample(spark, 150, seed=3))
    out = A.user_summary(act)
    assert out.count() == act.select("timezone_type", "bdate").distinct().count()
    assert out.columns == ["timezone_type", "bdate", "dau", "wau", "mau", "ru", "nru"]
    assert out.filter(F.col("wau") < F.col("dau")).count() == 0
