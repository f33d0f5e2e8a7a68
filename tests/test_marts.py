"""End-to-end mart behaviour on literal edge rows (FIXTURES section 3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martforge.plans import marts
from martforge.sources.scans import DatasetSpec, land

E = lambda y, m, d, h=0, mi=0: int((dt.datetime(y, m, d, h, mi) - dt.datetime(1970, 1, 1)).total_seconds())

ORDER_SCHEMA = (
    "idx long, pair_address string, order_id long, owner string, order_side int, price decimal(12,2), "
    "amount decimal(10,2), volume decimal(23,4), filled decimal(10,2), filled_volume decimal(23,4), "
    "price_usd_at decimal(12,2), volume_usd_at decimal(23,4), filled_usd_at decimal(23,4), created_at long, "
    "created_block long, created_hash string, closed_type int, closed_at long, closed_block long, closed_hash string"
)


def order(i, created, closed, closed_type=0, owner="0xo"):
    one = Decimal("1")
    return (i, "0xp", i, owner, 0, one, one, one, one, one, one, one, one, created, i, "h", closed_type, closed, i, "c")


def dims(spark):
    pairs = spark.createDataFrame([("0xp", "P/Q", "0xq", "0xb")], "pair_address string, pair_name string, quote_address string, base_address string")
    tokens = spark.createDataFrame(
        [("0xb", 1, "Base", "B", 18), ("0xq", 1, "Quote", "Q", 6), ("0xq", 2, "Quote2", "Q2", 0)],
        "address string, chain_id long, name string, symbol string, decimals int",
    )
    return pairs, tokens


def test_order_details_anti_join_at_end(spark):
    end = "2024-01-03"
    rows = [
        order(1, E(2024, 1, 1), E(2024, 1, 2, 10)),           # closed before end -> closed row only
        order(2, E(2024, 1, 1), E(2024, 1, 3, 0)),            # closes at end -> still open before end
        order(3, E(2024, 1, 2), None, closed_type=None),      # open, NULL closed_type
    ]
    src = spark.createDataFrame(rows, ORDER_SCHEMA)
    closed = land(src.filter(F.col("closed_at").isNotNull()), DatasetSpec("d", "close_orders", "closed_at"), "2024-01-01", end)
    snap = land(src, DatasetSpec("d", "user_orders", "created_at", mode="overwrite"), None, end)
    pairs, tokens = dims(spark)
    det = marts.order_details(closed, snap, pairs, tokens, end)
    got = sorted({(r["order_id"], r["is_completed"]) for r in det.collect()})
    assert got == [(1, 1), (2, 0), (3, 0)]
    # quote token address is on two chains: the DEX join on address alone fans out
    assert det.filter("order_id = 1").count() == 2
    daily = marts.order_daily(det, end).filter("timezone_type = 'utc'")
    assert {r["is_cancelled"] for r in daily.filter(F.col("owner") == "0xo").collect()} == {0, 1}


def test_bridge_daily_decimals_and_status(spark):
    v28 = Decimal("1234567890123456789012345678")
    rows = [
        (1, 1, 1, "0xb", "0xq", v28, Decimal(0), Decimal(0), "t1", "f1", E(2024, 1, 2, 1), 1),
        (2, 1, 9, "0xb", "0xq", Decimal(5000000), Decimal(0), Decimal(0), "t2", None, E(2024, 1, 2, 2), None),
        (3, 2, 1, "0xq", "0xb", Decimal(7), Decimal(0), Decimal(0), "t3", "f3", E(2024, 1, 2, 3), 0),
    ]
    hist = spark.createDataFrame(
        rows,
        "_id long, from_chain_id long, to_chain_id long, from_token string, to_token string, value decimal(38,0), "
        "exchange_fee decimal(38,0), network_fee decimal(38,0), initiated_tx_hash string, finalized_tx_hash string, "
        "initiated_time long, status int",
    ).withColumn("index", F.col("_id")).withColumn("from", F.lit("a")).withColumn("to", F.lit("b")) \
     .withColumn("extra_data", F.lit("0x")).withColumn("finalized_time", F.col("initiated_time"))
    landed = land(hist, DatasetSpec("b", "history", "initiated_time"), "2024-01-01", "2024-01-03")
    chains = spark.createDataFrame([(1, "one"), (2, "two")], "chain_id long, network string")
    _, tokens = dims(spark)
    det = marts.bridge_details(landed, chains, tokens, "2024-01-02", "2024-01-03")
    names = {r["_id"]: (r["from_chain_name"], r["to_chain_name"], r["from_token_symbol"]) for r in det.collect()}
    assert names == {1: ("one", "one", "B"), 2: ("one", None, "B"), 3: ("two", "one", "Q2")}
    price = spark.createDataFrame([("utc", dt.date(2024, 1, 2), "B", 1, Decimal("2.00"))],
                                  "timezone_type string, bdate date, symbol string, chain_id long, price_usd decimal(12,2)")
    out = marts.bridge_daily(det, price, tokens, "2024-01-02", "2024-01-03").filter("timezone_type = 'utc'")
    by = {r["from_token_symbol"] + "/" + str(r["to_chain_name"]): r for r in out.collect()}
    b = by["B/one"]
    assert b["success_cnt"] == 1 and b["failed_cnt"] == 0 and b["amount"] == Decimal("1234567890.1234567890")
    assert b["volume_usd"] == Decimal("2469135780.2469135780")
    n = by["B/None"]
    assert n["success_cnt"] == 0 and n["failed_cnt"] == 0 and n["finalized_cnt"] == 0 and n["amount"] is None
    q = by["Q2/one"]
    assert q["failed_cnt"] == 1 and q["amount"] is None and q["volume_usd"] is None


def test_bridge_daily_of_many_prices(spark):
    """Sums over all (transfer, price) pairs of a token and day, each rounded, though 900 million pairs are never made."""
    from decimal import ROUND_HALF_UP, localcontext

    day, n = dt.date(2024, 1, 2), 30_000
    at = F.lit(dt.datetime(2024, 1, 2, 3)).cast("timestamp_ntz")
    details = spark.range(n).select(
        F.lit(day).alias("dt_utc"), F.lit(day).alias("dt_kst"), at.alias("ts_utc"), at.alias("ts_kst"), F.col("id").alias("_id"), F.lit(1).cast("long").alias("from_chain_id"),
        F.lit("one").alias("from_chain_name"), F.lit(None).cast("string").alias("to_chain_name"), F.lit("a").alias("from_token"), F.lit("A").alias("from_token_symbol"),
        F.lit("T").alias("to_token_symbol"), ((F.col("id") % 7 - 3) * 1234567891 + 7).cast("decimal(38,0)").alias("value"), F.lit(0).cast("decimal(38,0)").alias("exchange_fee"),
        F.when(F.col("id") % 2 == 0, 5).cast("decimal(38,0)").alias("network_fee"), F.col("id").cast("string").alias("initiated_tx_hash"),
        F.lit(None).cast("string").alias("finalized_tx_hash"), F.lit(1).alias("status"),
    )
    tokens = spark.createDataFrame([("a", 1, 18)], "address string, chain_id long, decimals int")
    sizes = ["2.00", "33.33", None]
    price = spark.range(n).select(
        F.lit("utc").alias("timezone_type"), F.lit(day).alias("bdate"), F.lit("A").alias("symbol"), F.lit(1).cast("long").alias("chain_id"),
        F.element_at(F.array(*[F.lit(s) for s in sizes]), (F.col("id") % 3 + 1).cast("int")).cast("decimal(12,2)").alias("price_usd"),
    )
    r = marts.bridge_daily(details, price, tokens, day, "2024-01-03").filter("timezone_type = 'utc'").collect()
    assert len(r) == 1 and r[0]["initiated_cnt"] == n * n and r[0]["tx_cnt"] == n and r[0]["wide_cnt"] == 0
    with localcontext() as ctx:
        ctx.prec, ctx.rounding = 80, ROUND_HALF_UP
        step = Decimal("1E-10")
        values = [Decimal((k - 3) * 1234567891 + 7) for k in range(7)]
        times = [len(range(k, n, 7)) for k in range(7)]
        each = [sum((v * Decimal(p) / 10**18).quantize(step) for p in sizes if p) * (n // 3) for v in values]
        assert r[0]["volume_usd"] == sum(a * b for a, b in zip(each, times))
        assert r[0]["amount"] == sum((v / 10**18).quantize(step) * b for v, b in zip(values, times)) * n
        assert r[0]["network_fee"] == 5 * (n // 2) * n and r[0]["network_fee_usd"] == 0


def shuffles(df):
    """Shuffles of a plan as it ran, without those that broadcast or are read again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning")


def test_daily_marts_shuffle_their_rows_once(spark):
    """Fills and orders are dealt once, as narrow as they are; groups with NULL names and both zones are whole."""
    rows = spark.range(4000).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id % 700)").alias("ts_utc"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("P"), F.col("id") % 5)).alias("pair_name"), F.lit("0xp").alias("pair_address"),
        F.concat(F.lit("B"), F.left(F.lit(""), (F.col("id") % 2).cast("int"))).alias("base_symbol"), F.when(F.col("id") % 3 > 0, "Q").alias("quote_symbol"), F.concat(F.lit("t"), F.col("id") % 900).alias("txhash"),
        (F.col("id") % 2).cast("int").alias("order_side"), (F.col("id") % 2).cast("int").alias("is_taker"), F.col("id").alias("block"),
        *[(F.col("id") + k).cast("decimal(12,2)").alias(c) for k, c in enumerate(("price", "amount", "volume", "volume_usd", "fee", "fee_usd"))],
    ).withColumn("ts_kst", F.expr("ts_utc + interval 9 hours"))
    rows = rows.withColumn("dt_utc", F.to_date("ts_utc")).withColumn("dt_kst", F.to_date("ts_kst"))
    start, end = "2024-01-01", "2024-03-01"
    both = [rows.withColumn("timezone_type", F.lit(z)).withColumn("bdate", F.col(f"dt_{z}")).filter(F.col("bdate").between("2024-01-01", "2024-02-29")) for z in ("utc", "kst")]
    zoned = both[0].unionByName(both[1])

    trades = marts.trade_daily(rows, start, end)
    want = zoned.filter("is_taker = 1").groupBy(*marts.TRADE_DAILY_KEYS).agg(F.count_distinct("txhash").alias("tx_cnt"), F.sum("fee").cast("decimal(38,10)").alias("fee"))
    got = trades.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert shuffles(trades) == 1

    pairs = spark.createDataFrame([("0xp", "P", "0xq", "0xb")], "pair_address string, pair_name string, quote_address string, base_address string")
    tokens = spark.createDataFrame([("0xb", "Base", "B"), ("0xq", "Quote", "Q")], "address string, name string, symbol string")
    fills = rows.drop("pair_name", "base_symbol", "quote_symbol")
    matches = marts.order_matches_daily(fills, pairs, tokens, start, end)
    want = zoned.groupBy("timezone_type", "bdate", "order_side").agg(F.sum("amount").cast("decimal(38,10)").alias("total_amount"), F.max("block").alias("last_block"))
    got = matches.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = matches._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Generate inline(array") < plan.index("RepartitionByExpression")

    tvl = spark.createDataFrame([("utc", dt.date(2024, 1, 1), None, "B", None, Decimal(7)), ("utc", dt.date(2025, 1, 1), None, None, "Q", Decimal(9))],
                                "timezone_type string, bdate date, pair_name string, base_symbol string, quote_symbol string, tvl_usd decimal(38,10)")
    joined = marts.trade_daily_with_tvl(trades, tvl, open_only=True)
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
    have = {r["bdate"]: (r["tx_cnt"] > 0, r["tvl_usd"]) for r in joined.filter("tvl_usd > 0").collect()}
    assert have == {dt.date(2024, 1, 1): (True, 7), dt.date(2025, 1, 1): (False, 9)} and joined.count() == trades.count() + 1
