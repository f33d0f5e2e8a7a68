"""Source roles bound to the driver's test tables.

The marts are written against the source shapes of a trading / bridge /
wallet system (orders, fills, fees, pairs, tokens, chains, transfers,
prices, chain stats). The test data is a TPC-H-like star schema plus an
``events`` stream, so each role is derived from one test table with plain
column expressions (no invented rows, every derived table grows with its
input). ``plans/oracle.py`` states the same bindings in SQL.

Roles:
* orders (+ a deterministic seconds offset, because ``o_orderdate`` is
  always midnight) -> order snapshot and closed orders
* lineitem joined to offset orders -> fills (match histories)
* lineitem -> fee collections, which borrow their time from the fills
* supplier -> trading pairs; nation -> tokens; region -> chains
* events -> bridge transfers, token prices and chain-stat samples
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.scalars import hex_address, ts_to_epoch
from martforge.sources.scans import OVERWRITE, DatasetSpec

# --- fixed values: binding parameters ---------------------------------------
OFFSET_MULTIPLIER = 7919        # seconds offset = (o_orderkey * 7919) % 86400
SECONDS_PER_DAY = 86400
PRICE_HOURS = (0, 6, 15, 18)    # hours of price samples; 0 and 15 are the two midnights
VALUE_POWERS = 12               # transfer values are cents times 10 ** (event_id % 12)
CLOSE_STEP_DAYS = 15            # orders close 0, 15, 30, 45 or 60 days after creation
PAIRS_PER_ORDER_KEY = 50        # order -> pair (supplier) key
TOKEN_COUNT = 25                # nation keys 0..24
CHAIN_COUNT = 5                 # region keys 0..4
ROUTE_CHAINS = 7                # to_chain_id range; 5 and 6 have no chain row
Q4 = "decimal(18,4)"            # declared types of derived money columns
Q6 = "decimal(18,6)"
# ---------------------------------------------------------------------------


# Declared input schemas (no inference job per read; a file that does not
# match fails loudly instead of being silently re-typed).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pow10(n: F.Column) -> F.Column:
    """Exact power of ten for 0 <= n <= 18."""
    return F.concat(F.lit("1E"), n.cast("string")).cast("decimal(19,0)")


def d(value: str | F.Column, typ: str) -> F.Column:
    c = F.col(value) if isinstance(value, str) else value
    return c.cast(typ)


def orders_ts(orders: DataFrame) -> DataFrame:
    """Orders with ``ts`` = order date + (o_orderkey * 7919) % 86400 seconds."""
    secs = (F.col("o_orderkey") * OFFSET_MULTIPLIER) % SECONDS_PER_DAY
    return orders.withColumn("ts", F.timestamp_add("SECOND", secs, F.col("o_orderdate")))


# --- dimensions --------------------------------------------------------------
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        d("n_nationkey", "bigint").alias("_id"),
        d(F.col("n_nationkey") % CHAIN_COUNT, "bigint").alias("chain_id"),
        hex_address(d("n_nationkey", "bigint")).alias("address"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("TK"), d("n_nationkey", "string")).alias("symbol"),
        d(F.col("n_nationkey") % 19, "int").alias("decimals"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        hex_address("s_suppkey").alias("pair_address"),
        F.col("s_name").alias("pair_name"),
        hex_address(d((F.col("s_nationkey") + 1) % TOKEN_COUNT, "bigint")).alias("quote_address"),
        hex_address(d("s_nationkey", "bigint")).alias("base_address"),
        d(((F.col("s_nationkey") + 1) % TOKEN_COUNT) % 19, "int").alias("quote_decimals"),
        d(F.col("s_nationkey") % 19, "int").alias("base_decimals"),
        (F.col("s_suppkey") * 3600).alias("open_time"),
        d("s_acctbal", "decimal(12,2)").alias("open_price"),
    )


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(d("r_regionkey", "bigint").alias("chain_id"), F.col("r_name").alias("network"))


# --- orders ------------------------------------------------------------------
def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live order table (all orders, open or closed)."""
    o = orders_ts(table(spark, sf_dir, "orders"))
    price = d("o_totalprice", "decimal(12,2)")
    amount = d((F.col("o_orderkey") % 9) + 1, "decimal(10,2)")
    filled = (
        F.when(F.col("o_orderstatus") == "F", amount)
        .when(F.col("o_orderstatus") == "P", F.lit(1).cast("decimal(10,2)"))
        .otherwise(F.lit(0).cast("decimal(10,2)"))
    )
    created = ts_to_epoch("ts")
    closed_type = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(1))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("int"))
        .otherwise(F.lit(2))
    )
    return o.select(
        F.col("o_orderkey").alias("idx"),
        hex_address(F.col("o_orderkey") % PAIRS_PER_ORDER_KEY).alias("pair_address"),
        F.col("o_orderkey").alias("order_id"),
        hex_address("o_custkey").alias("owner"),
        d(F.col("o_orderkey") % 2, "int").alias("order_side"),
        price.alias("price"),
        amount.alias("amount"),
        (price * amount).cast(Q4).alias("volume"),
        filled.alias("filled"),
        (filled * price).cast(Q4).alias("filled_volume"),
        price.alias("price_usd_at"),
        (price * amount).cast(Q4).alias("volume_usd_at"),
        (filled * price).cast(Q4).alias("filled_usd_at"),
        created.alias("created_at"),
        F.col("o_orderkey").alias("created_block"),
        hex_address(F.col("o_orderkey") * 3).alias("created_hash"),
        closed_type.cast("int").alias("closed_type"),
        (created + (F.col("o_orderkey") % 5) * CLOSE_STEP_DAYS * SECONDS_PER_DAY + 3600).alias("closed_at"),
        (F.col("o_orderkey") + 1000).alias("closed_block"),
        hex_address(F.col("o_orderkey") * 3 + 1).alias("closed_hash"),
        F.col("o_orderstatus"),
    )


ORDER_COLUMNS = (
    "idx", "pair_address", "order_id", "owner", "order_side", "price", "amount", "volume", "filled",
    "filled_volume", "price_usd_at", "volume_usd_at", "filled_usd_at", "created_at", "created_block",
    "created_hash", "closed_type", "closed_at", "closed_block", "closed_hash",
)

SNAPSHOT_SPEC = DatasetSpec("dex", "user_orders", "created_at", mode=OVERWRITE, select=ORDER_COLUMNS)
CLOSED_SPEC = DatasetSpec("dex", "close_orders", "closed_at", select=ORDER_COLUMNS)


def closed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rows(spark, sf_dir).filter(F.col("o_orderstatus") == "F")


# --- fills and fees ----------------------------------------------------------
def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match histories: one row per line item, timed by its order."""
    li = table(spark, sf_dir, "lineitem")
    o = orders_ts(table(spark, sf_dir, "orders")).select("o_orderkey", "o_custkey", "ts")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    price = d("l_extendedprice", "decimal(12,2)")
    amount = d("l_quantity", "decimal(10,2)")
    tax = d("l_tax", "decimal(4,2)")
    keep = 1 - d("l_discount", "decimal(4,2)")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("idx"),
        hex_address("l_suppkey").alias("pair_address"),
        F.col("l_orderkey").alias("order_id"),
        hex_address("o_custkey").alias("owner"),
        d(F.col("l_linenumber") % 2, "int").alias("order_side"),
        F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(0)).alias("is_taker"),
        price.alias("price"),
        amount.alias("amount"),
        (price * amount).cast(Q4).alias("volume"),
        (price * tax).cast(Q4).alias("fee"),
        (price * keep).cast(Q4).alias("price_usd_at"),
        (price * amount * keep).cast(Q6).alias("volume_usd_at"),
        (price * tax * keep).cast(Q6).alias("fee_usd_at"),
        ts_to_epoch("ts").alias("time_utc"),
        F.col("l_orderkey").alias("block"),
        hex_address("l_orderkey").alias("hash"),
    )


FILLS_SPEC = DatasetSpec("dex", "match_histories", "time_utc")


def fee_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fee collections; they carry a block number but no time of their own."""
    li = table(spark, sf_dir, "lineitem")
    gross = d("l_extendedprice", "decimal(12,2)")
    fee = (gross * d("l_tax", "decimal(4,2)")).cast(Q4)
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("idx"),
        hex_address("l_suppkey").alias("pair_address"),
        F.col("l_orderkey").alias("order_id"),
        hex_address("l_partkey").alias("owner"),
        gross.alias("gross_amount"),
        hex_address(F.col("l_suppkey") % 7).alias("recipient"),
        d(F.col("l_linenumber") * 5, "int").alias("fee_bps"),
        fee.alias("fee"),
        fee.alias("fee_usd_at"),
        (gross - fee).cast(Q4).alias("net_amount"),
        F.col("l_orderkey").alias("block"),
        hex_address(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("hash"),
    )


FEES_SPEC = DatasetSpec("dex", "fee_collectors t1 left outer join match_histories", "time_utc")


# --- events-derived roles ----------------------------------------------------
def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge history: one transfer per event."""
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    epoch = ts_to_epoch("ts")
    return e.select(
        F.col("event_id").alias("_id"),
        (F.col("user_id") % CHAIN_COUNT).alias("from_chain_id"),
        ((F.col("user_id") + F.col("event_id")) % ROUTE_CHAINS).alias("to_chain_id"),
        F.col("event_id").alias("index"),
        hex_address(F.col("user_id") % TOKEN_COUNT).alias("from_token"),
        hex_address((F.col("user_id") + 3) % TOKEN_COUNT).alias("to_token"),
        hex_address("user_id").alias("from"),
        hex_address(F.col("user_id") + 1).alias("to"),
        ((d("value", "decimal(12,2)") * 100).cast("decimal(18,0)") * pow10(F.col("event_id") % VALUE_POWERS)).cast("decimal(38,0)").alias("value"),
        (F.col("event_id") % 1000).cast("decimal(38,0)").alias("exchange_fee"),
        (F.col("user_id") % 100 + 1).cast("decimal(38,0)").alias("network_fee"),
        hex_address(F.col("event_id") % 16).alias("extra_data"),
        hex_address("event_id").alias("initiated_tx_hash"),
        F.when(failed, F.lit(None).cast("string")).otherwise(hex_address(F.col("event_id") + 1000000000)).alias("finalized_tx_hash"),
        epoch.alias("initiated_time"),
        F.when(failed, F.lit(None).cast("bigint")).otherwise(epoch + 600).alias("finalized_time"),
        F.when(failed, F.lit(0)).when(F.col("event_type") == "signup", F.lit(None).cast("int")).otherwise(F.lit(1)).cast("int").alias("status"),
    )


TRANSFERS_SPEC = DatasetSpec("bridge", "history", "initiated_time")


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token price samples: one per event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("_id"),
        (F.col("user_id") % CHAIN_COUNT).alias("chain_id"),
        hex_address(F.col("user_id") % TOKEN_COUNT).alias("address"),
        d("value", "decimal(12,2)").alias("price_usd"),
        d(F.col("event_id") % 3, "int").alias("interval_flags"),
        # sampled at minute 0 or 30 of four hours of the event's day
        (
            ts_to_epoch("ts")
            - ts_to_epoch("ts") % SECONDS_PER_DAY
            + F.element_at(F.array(*[F.lit(h) for h in PRICE_HOURS]), (F.floor(F.col("event_id") / 2) % 4 + 1).cast("int")) * 3600
            + (F.col("event_id") % 2) * 1800
        ).alias("updated_at"),
    )


PRICES_SPEC = DatasetSpec("wallet", "token_price", "updated_at", predicate="minute(ts_utc) = 0")


def stat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain-stat samples: one poll per event, stamped with the event time."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("value").alias("average_block_time"),
        F.col("value").alias("coin_price"),
        d("user_id", "double").alias("gas_prices_average"),
        d("user_id", "int").alias("total_addresses"),
        (F.col("event_id") * 10).alias("total_blocks"),
        (F.col("event_id") * 100 + F.col("user_id")).alias("total_transactions"),
        (F.col("event_id") * 21000).alias("total_gas_used"),
        F.col("user_id").alias("transactions_today"),
        (F.col("event_id") + 1000000).alias("market_cap"),
        (F.col("user_id") * 21000).alias("gas_used_today"),
        F.col("event_id").alias("tvl"),
    )


STATS_SPEC = DatasetSpec("bridge", "chain_stats", "ts", time_kind="timestamp")
