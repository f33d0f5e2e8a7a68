import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from martforge.functions.scalars import (
    cancelled_flag,
    exact_avg,
    hex_address,
    midnight_distance,
    report_ts,
    safe_cast,
    money_sum,
    scale_units,
    scale_units_double,
    usd_value,
    usd_value_double,
)


def test_hex_address(spark):
    df = spark.createDataFrame([(255, "Ab")], "n long, s string")
    r = df.select(hex_address("n").alias("a"), hex_address(F.col("s").cast("binary")).alias("b")).first()
    assert r["a"] == "0xff" and r["b"] == "0x4162"


def test_scale_units_exact(spark):
    df = spark.createDataFrame(
        [("1234567890123456789012345678", 18), ("1000000", 6), ("5", 0), ("7", None), ("7", 19), ("7", -1)],
        "v string, d int",
    ).select(F.col("v").cast("decimal(38,0)").alias("v"), "d")
    out = [r["x"] for r in df.select(scale_units("v", "d").alias("x")).collect()]
    assert out[0] == Decimal("1234567890.1234567890")
    assert out[1] == Decimal("1.0000000000")
    assert out[2] == Decimal("5.0000000000")
    assert out[3] is None
    assert out[4] == 0 and out[5] == Decimal("70.0000000000")  # any exponent


def test_wide_amounts_are_exact(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        v = rng.randrange(10 ** rng.randrange(1, 39)) * rng.choice([1, 1, -1])
        p = Decimal(rng.randrange(10 ** rng.randrange(2, 19))).scaleb(-rng.randrange(0, 19))
        rows.append((Decimal(v), p, rng.randrange(0, 31)))
    rows += [(Decimal(5 * 10**24), Decimal(60000), 18), (Decimal(3), Decimal("0.000123"), 0), (Decimal(10**29), Decimal(1), 18), (Decimal(1000), Decimal(1), 24)]
    df = spark.createDataFrame(rows, "v decimal(38,0), p decimal(38,18), d int")
    got = df.select("v", "p", "d", scale_units("v", "d").alias("t"), usd_value("v", "p", "d").alias("u"),
                    scale_units_double("v", "d").alias("tf"), usd_value_double("v", "p", "d").alias("uf")).collect()
    with localcontext() as ctx:
        ctx.prec, ctx.rounding = 120, ROUND_HALF_UP
        for r in got:
            for have, approx, exact in ((r["t"], r["tf"], r["v"].scaleb(-r["d"])), (r["u"], r["uf"], (r["v"] * r["p"]).scaleb(-r["d"]))):
                want = exact.quantize(Decimal("1E-10"))
                assert have == want if abs(want) < 10**28 else have is None
                assert math.isclose(approx, float(exact), rel_tol=1e-9)


def test_usd_value_rounds_once(spark):
    # 99 * 0.05 / 10**11 = 4.95e-11: one HALF_UP rounding to 10 digits gives 0;
    # rounding to 12 digits first (5.0e-11) and then to 10 would give 1e-10
    df = spark.createDataFrame([(Decimal("99"), Decimal("0.05"), 11), (Decimal("12345"), Decimal("2.50"), 2)],
                               "v decimal(38,0), p decimal(12,2), d int")
    out = [r["x"] for r in df.select(usd_value("v", "p", "d").alias("x")).collect()]
    assert out == [Decimal("0E-10"), Decimal("308.6250000000")]


def test_midnight_distance_branches(spark):
    import datetime as dt

    cases = {
        (0, 0): 0, (0, 4): 4, (0, 10): 10, (23, 45): 15, (23, 59): 1,
        (14, 59): 601, (15, 0): 600, (15, 7): 607, (12, 0): 9999,
    }
    data = [(dt.datetime(2024, 1, 2, h, m),) for h, m in cases]
    df = spark.createDataFrame(data, "ts timestamp_ntz")
    got = {(r["ts"].hour, r["ts"].minute): r["d"] for r in df.select("ts", midnight_distance("ts").alias("d")).collect()}
    assert got == cases


def test_cancelled_flag_null_is_cancelled(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "c int")
    assert [r[0] for r in df.select(cancelled_flag("c")).collect()] == [0, 1, 1]


def test_safe_cast(spark):
    df = spark.createDataFrame([("12",), ("abc",), ("",), (None,), ("12.345",)], "s string")
    out = df.select(safe_cast("s", "int").alias("i"), safe_cast("s", "decimal(38,2)").alias("d")).collect()
    assert [r["i"] for r in out][:4] == [12, None, None, None]
    assert out[4]["d"] == Decimal("12.35")


def test_exact_avg_and_report_ts(spark):
    import datetime as dt

    df = spark.createDataFrame([(Decimal("1.10"),), (Decimal("2.20"),), (None,)], "p decimal(12,2)")
    assert abs(df.select(exact_avg("p")).first()[0] - 1.65) < 1e-12
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 678),)], "t timestamp_ntz")
    assert ts.select(report_ts("t")).first()[0] == "2024-01-02 03:04:05"


def test_wide_money_sum_keeps_integer_digits(spark):
    df = spark.createDataFrame([(Decimal("99999999999999999999.5"),), (Decimal("99999999999999999999.25"),), (Decimal("-1.75"),)], "x decimal(38,18)")
    assert df.select(money_sum("x", wide=True)).first()[0] == Decimal("199999999999999999997.0000000000")
