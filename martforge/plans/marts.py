"""Derived tables D1-D11 and D16 as DataFrame functions.

Inputs are *landed* tables: source rows plus ``ts_utc, dt_utc, ts_kst,
dt_kst`` (see ``martforge.sources.scans``). Every function takes an explicit
half-open slice and returns a DataFrame; nothing is collected (``bridge_daily``
checkpoints its rows, the others are lazy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martforge.functions.scalars import (
    COUNTER,
    MONEY,
    MONEY_SCALE,
    PRICE_SCALE,
    cancelled_flag,
    exact_avg,
    money_sum,
    scale_units,
    scale_units_double,
    unscaled,
    usd_value,
    usd_value_double,
)
from martforge.operators.enrich import attach_role, remove_matched
from martforge.operators.snapshot import closest_to_midnight
from martforge.operators.timeslice import (
    WEEK,
    DateLike,
    clip_days,
    cover_zones,
    deal_by_week,
    fan_out_zones,
    filter_by_time,
    filter_by_time_end,
    shift_days,
)
from martforge.operators.union import union_by_name
from martforge.session import materialize

PAIR_COLUMNS = {"pair_name": "pair_name", "quote_address": "quote_address", "base_address": "base_address"}


def _with_pair_and_tokens(df: DataFrame, pairs: DataFrame, tokens: DataFrame, token_address_wins: bool = False) -> DataFrame:
    """J1 + J3: pair by ``pair_address``, then token as base and as quote.

    Broadcast is left to Spark's size checks (static estimate from file
    sizes, then AQE's measured size); no dimension is hinted blindly.
    """
    out = attach_role(df, pairs, [("pair_address", "pair_address")], PAIR_COLUMNS, "pair")
    base = {"base_name": "name", "base_symbol": "symbol"}
    quote = {"quote_name": "name", "quote_symbol": "symbol"}
    if token_address_wins:
        base["base_address"] = "address"
        quote["quote_address"] = "address"
    out = attach_role(out, tokens, [("base_address", "address")], base, "base")
    return attach_role(out, tokens, [("quote_address", "address")], quote, "quote")


# The column and key lists of D1-D9 below are the published table
# contracts and must keep these names and this order.

# D1 -------------------------------------------------------------------------
def trade_detail_columns() -> list:
    return [
    "dt_utc", "dt_kst", "ts_utc", "ts_kst", "block", F.col("time_utc").alias("block_time"),
    F.col("hash").alias("txhash"), "idx", "pair_name", "pair_address", "quote_address", "quote_name",
    "quote_symbol", "base_address", "base_name", "base_symbol", "owner", "order_side", "is_taker", "price",
    F.col("price_usd_at").alias("price_usd"), "amount", "volume", F.col("volume_usd_at").alias("volume_usd"),
    "fee", F.col("fee_usd_at").alias("fee_usd"),
    ]


def trade_details(matches: DataFrame, pairs: DataFrame, tokens: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Fills in ``[start, end)`` (UTC day) with pair and token names."""
    sliced = filter_by_time(matches, start, end)
    return _with_pair_and_tokens(sliced, pairs, tokens).select(*trade_detail_columns())


# D2 -------------------------------------------------------------------------
def order_detail_columns() -> list:
    return [
    "dt_utc", "dt_kst", "ts_utc", "ts_kst", "order_id", "created_block", "created_hash", "is_completed",
    "closed_type", "closed_at", "closed_block", "closed_hash", "pair_name", "pair_address", "quote_address",
    "quote_name", "quote_symbol", "base_address", "base_name", "base_symbol", "owner", "order_side", "price",
    F.col("price_usd_at").alias("price_usd"), "amount", (F.col("price_usd_at") * F.col("amount")).alias("amount_usd"),
    "filled", F.col("filled_usd_at").alias("filled_usd"), "volume",
    F.col("volume_usd_at").alias("volume_usd"), "filled_volume",
    # kept as in the source mart: filled_volume_usd repeats filled_usd_at
    F.col("filled_usd_at").alias("filled_volume_usd"),
    ]


def order_details(closed: DataFrame, snapshot: DataFrame, pairs: DataFrame, tokens: DataFrame, end: DateLike) -> DataFrame:
    """Closed orders (flag 1) plus still-open snapshot orders (flag 0).

    Dates mean close time for closed rows and creation time for open rows.
    """
    done = filter_by_time_end(closed.withColumn("is_completed", F.lit(1)), end)
    live = filter_by_time_end(snapshot.withColumn("is_completed", F.lit(0)), end)
    still_open = remove_matched(live, done, ["order_id", "pair_address"])
    both = union_by_name(done, still_open)
    return _with_pair_and_tokens(both, pairs, tokens).select(*order_detail_columns())


# D3 -------------------------------------------------------------------------
ORDER_DAILY_KEYS = [
    "timezone_type", "bdate", "pair_name", "pair_address", "quote_address", "quote_name", "quote_symbol",
    "base_address", "base_name", "base_symbol", "owner", "order_side", "is_cancelled",
]
ORDER_DAILY_SUMS = [
    "amount", "amount_usd", "filled", "filled_usd", "volume", "volume_usd", "filled_volume", "filled_volume_usd",
]


def order_daily(details: DataFrame, end: DateLike) -> DataFrame:
    """D3: all orders up to ``end`` per zone-day and 13 keys.

    Orders are dealt by (week, owner, pair) once each and fanned out to the zones behind that
    shuffle (see ``deal_by_week``): a total of one order is wider than the order.
    """
    orders = details.filter(cover_zones(None, end)) if "ts_utc" in details.columns else details
    orders = orders.withColumn("is_cancelled", cancelled_flag("closed_type"))
    orders = orders.select("dt_utc", "dt_kst", *ORDER_DAILY_KEYS[2:], "price", "price_usd", *ORDER_DAILY_SUMS)
    zoned = fan_out_zones(deal_by_week(orders, "owner", "pair_address"), None, end)
    return zoned.groupBy(WEEK, *ORDER_DAILY_KEYS).agg(
        exact_avg("price").alias("avg_price"),
        exact_avg("price_usd").alias("avg_price_usd"),
        *[money_sum(c).alias(c) for c in ORDER_DAILY_SUMS],
    ).drop(WEEK)


# D4 -------------------------------------------------------------------------
FEE_DAILY_KEYS = [
    "timezone_type", "bdate", "pair_name", "pair_address", "quote_address", "quote_name", "quote_symbol",
    "base_address", "base_name", "base_symbol", "recipient",
]


def fee_daily(fees: DataFrame, pairs: DataFrame, tokens: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Fee totals per zone-day, pair and recipient.

    Base/quote addresses come from the token side (NULL when unmatched). Fees are
    summed by (UTC day, KST day, pair, recipient) first; only those totals are fanned out to
    the zones and joined with names.
    """
    sums = ["gross_amount", "net_amount", "fee"]
    cover = fees.filter(cover_zones(start, end)) if "ts_utc" in fees.columns else fees
    totals = cover.groupBy("dt_utc", "dt_kst", "pair_address", "recipient").agg(*[F.sum(c).alias(c) for c in sums])
    zoned = fan_out_zones(totals, start, end, ts_col=None).groupBy("timezone_type", "bdate", "pair_address", "recipient").agg(
        *[F.sum(c).alias(c) for c in sums]
    )
    enriched = _with_pair_and_tokens(zoned, pairs, tokens, token_address_wins=True)
    return enriched.groupBy(*FEE_DAILY_KEYS).agg(*[money_sum(c).alias(c) for c in sums])


# D5 -------------------------------------------------------------------------
def order_matches_daily(matches: DataFrame, pairs: DataFrame, tokens: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Aggregate fills per pair and side first (A11), then attach names.

    Fills are dealt by (week, pair, side) as they are, and fanned out to the zones behind that
    shuffle, where a group's rows already lie together: totals of sparse groups are wider than fills.

    O1 "sort before write" is a per-partition sort: a written table keeps no
    global order, so a range shuffle (and its sampling job) would buy nothing.
    """
    fills = matches.filter(cover_zones(start, end)) if "ts_utc" in matches.columns else matches
    fills = fills.select("dt_utc", "dt_kst", "pair_address", "order_side", "price", "amount", "fee", "block")
    zoned = fan_out_zones(deal_by_week(fills, "pair_address", "order_side"), start, end)
    agg = zoned.groupBy(WEEK, "timezone_type", "bdate", "pair_address", "order_side").agg(
        exact_avg("price").alias("avg_price"),
        money_sum("amount").alias("total_amount"),
        money_sum("fee").alias("total_fee"),
        F.max("block").alias("last_block"),
    )
    enriched = _with_pair_and_tokens(agg, pairs, tokens)
    return enriched.select(
        "timezone_type", "bdate", "pair_name", "pair_address", "quote_name", "quote_symbol", "quote_address",
        "base_name", "base_symbol", "base_address", "order_side", "avg_price", "total_amount", "total_fee",
        "last_block",
    ).sortWithinPartitions("bdate")


# D6 -------------------------------------------------------------------------
TRADE_DAILY_KEYS = ["timezone_type", "bdate", "pair_name", "base_symbol", "quote_symbol"]


def trade_daily(details: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Taker fills per zone-day and pair.

    One shuffle: a day's fills of a pair are dealt by the keys of the result, as narrow as they are
    read, and counted and summed where they lie.
    """
    sums = ["amount", "volume", "volume_usd", "fee", "fee_usd"]
    takers = details.filter(F.col("is_taker") == 1).filter(cover_zones(start, end))
    takers = takers.select("dt_utc", "dt_kst", *TRADE_DAILY_KEYS[2:], "txhash", "price", *sums)
    return fan_out_zones(takers, start, end, ts_col=None).repartition(*TRADE_DAILY_KEYS).groupBy(*TRADE_DAILY_KEYS).agg(
        F.count_distinct("txhash").alias("tx_cnt"),
        F.min("price").cast(MONEY).alias("low_price"),
        F.max("price").cast(MONEY).alias("high_price"),
        exact_avg("price").alias("avg_price"),
        *[money_sum(c).alias(c) for c in sums],
    )


# D16 ------------------------------------------------------------------------
def open_order_tvl(details: DataFrame, end: DateLike) -> DataFrame:
    """Value still resting in open orders: what side 0 holds in base, side 1 in quote."""
    zoned = fan_out_zones(details.filter(F.col("is_completed") == 0), None, end)

    def resting(side: int, value):
        total = F.sum(F.when(F.col("order_side") == side, value.cast(MONEY))).cast(MONEY)
        return F.coalesce(total, F.lit(0).cast(MONEY))

    unfilled = F.col("amount") - F.col("filled")
    per_key = zoned.groupBy(*TRADE_DAILY_KEYS).agg(
        resting(0, unfilled).alias("tvl_base"),
        resting(0, unfilled * F.col("price_usd")).alias("tvl_base_usd"),
        resting(1, F.col("volume") - F.col("filled_volume")).alias("tvl_quote"),
        resting(1, F.col("volume_usd") - F.col("filled_volume_usd")).alias("tvl_quote_usd"),
    )
    return per_key.withColumn("tvl_usd", (F.col("tvl_base_usd") + F.col("tvl_quote_usd")).cast(MONEY))


def trade_daily_with_tvl(trades: DataFrame, tvl: DataFrame, open_only: bool = False) -> DataFrame:
    """D16 tail: trade mart joined to open-order value, NULL -> 0.

    ``open_only`` also keeps keys with open orders and no trade (all trade
    numbers 0); null-safe keys, since unmatched names are NULL on either side. Both
    sides have a row per key, so there it is a union whose rows are brought together by key: groups take NULL keys
    as they are, where a null-safe join would shuffle and sort both sides by computed keys.
    """
    if not open_only:
        return trades.join(tvl, TRADE_DAILY_KEYS, "left").na.fill(0)
    rest = [c for c in trades.columns + tvl.columns if c not in TRADE_DAILY_KEYS]
    both = trades.unionByName(tvl, allowMissingColumns=True)
    return both.groupBy(*TRADE_DAILY_KEYS).agg(*[F.max(c).alias(c) for c in rest]).na.fill(0)


# D8 -------------------------------------------------------------------------
BRIDGE_DETAIL_COLUMNS = [
    "dt_utc", "dt_kst", "ts_utc", "ts_kst", "initiated_time", "finalized_time", "_id", "from_chain_id",
    "from_chain_name", "to_chain_id", "to_chain_name", "index", "from_token", "from_token_symbol", "to_token",
    "to_token_symbol", "from", "to", "value", "exchange_fee", "network_fee", "extra_data", "initiated_tx_hash",
    "finalized_tx_hash", "status",
]


def bridge_details(history: DataFrame, chains: DataFrame, tokens: DataFrame, start: DateLike, end: DateLike, lookback_days: int = 1) -> DataFrame:
    """Transfers with chain names and token symbols on both ends.

    The slice starts ``lookback_days`` early so late status updates of the
    previous day are rewritten (I2).
    """
    sliced = filter_by_time(history, shift_days(start, -lookback_days), end)
    out = attach_role(sliced, chains, [("from_chain_id", "chain_id")], {"from_chain_name": "network"}, "fchain")
    out = attach_role(out, chains, [("to_chain_id", "chain_id")], {"to_chain_name": "network"}, "tchain")
    out = attach_role(
        out, tokens, [("from_token", "address"), ("from_chain_id", "chain_id")], {"from_token_symbol": "symbol"}, "ftoken"
    )
    out = attach_role(
        out, tokens, [("to_token", "address"), ("to_chain_id", "chain_id")], {"to_token_symbol": "symbol"}, "ttoken"
    )
    return out.select(*[F.col(f"`{c}`") for c in BRIDGE_DETAIL_COLUMNS])


# D11 ------------------------------------------------------------------------
def midnight_price(prices: DataFrame, tokens: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """The hour-0 price of each zone-day closes the *previous* day."""
    coarse = prices.filter((F.hour("ts_utc") == 0) | (F.hour("ts_kst") == 0))
    zoned = fan_out_zones(coarse, start, end)
    at_midnight = zoned.filter(
        ((F.col("timezone_type") == "utc") & (F.hour("ts_utc") == 0))
        | ((F.col("timezone_type") == "kst") & (F.hour("ts_kst") == 0))
    )
    named = attach_role(
        at_midnight, tokens, [("address", "address"), ("chain_id", "chain_id")],
        {"symbol": "symbol", "decimals": "decimals"}, "token",
    )
    return named.select(
        "timezone_type", F.date_sub("bdate", 1).alias("bdate"), "ts_utc", "ts_kst", "chain_id", "address",
        "symbol", "decimals", "price_usd",
    )


# D9 -------------------------------------------------------------------------
BRIDGE_DAILY_KEYS = ["timezone_type", "bdate", "from_chain_name", "to_chain_name", "from_token_symbol", "to_token_symbol"]
#: What a price of the day is found by.
PRICE_KEYS = ["from_token_symbol", "from_chain_id", "timezone_type", "bdate"]
#: Amounts that are valued: raw column -> published column.
USD_COLUMNS = {"value": "volume_usd", "exchange_fee": "exchange_fee_usd", "network_fee": "network_fee_usd"}
PRICE_PARTS = 8  # tasks that share the amounts of one price key


def _money(units) -> Column:
    """A whole number of 1E-10 as money (a product with 1E-10 or a sum of two such decimals would lose digits)."""
    return F.concat(units.cast("string"), F.lit(f"E-{MONEY_SCALE}")).cast(MONEY)


def _bridge_prices(daily_price: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Distinct prices by ``PRICE_KEYS`` with their numbers, what all of them add up to, and their scale.

    ``unit``: digits of |price| as an integer; ``weight``: positive less negative prices of that size.
    """
    kind = daily_price.schema["price_usd"].dataType
    scale = min(PRICE_SCALE, kind.scale) if isinstance(kind, DecimalType) else PRICE_SCALE
    names = {"symbol": "from_token_symbol", "chain_id": "from_chain_id"}
    prices = daily_price.select(*[F.col(c).alias(names.get(c, c)) for c in ("symbol", "chain_id", "timezone_type", "bdate")], "price_usd")
    exact = F.col("price_usd").cast(f"decimal(38,{PRICE_SCALE})")
    digits = unscaled(exact)
    sized = prices.select(
        *PRICE_KEYS, F.signum(exact).cast("int").alias("sign"), F.left(digits, F.length(digits) - (PRICE_SCALE - scale)).cast(COUNTER).alias("unit")
    )
    known = materialize(sized.groupBy(*PRICE_KEYS, "unit").agg(F.count(F.lit(1)).alias("n"), F.sum("sign").alias("weight")))
    totals = known.groupBy(*PRICE_KEYS).agg(
        F.sum("n").alias("n_prices"),
        F.sum((F.col("unit") * F.col("weight").cast("decimal(18,0)")).cast(COUNTER)).alias("units"),
        F.sum(F.col("unit").cast("double") * F.col("n")).alias("units_size"),
        F.max(F.col("unit").cast("double")).alias("most"),
    )
    return known.filter("unit > 0 AND weight <> 0"), totals, scale


def _rounded_parts(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Per route the sums of ``round(low * unit / modulus)`` over amounts and prices, in units of 1E-10.

    Rounding does not add up, so this is the one step that pairs amounts with prices: distinct remainders with
    distinct prices of a key, in long arithmetic, and only remainders that a price can bring to half a unit.
    """
    lows = [
        F.struct(F.lit(c).alias("kind"), F.col(f"{c}_low").alias("low"), F.col(f"{c}_sign").alias("sign")) for c in USD_COLUMNS
    ]
    low = rows.select(*BRIDGE_DAILY_KEYS, "from_chain_id", "modulus", "most", F.inline(F.array(*lows)))
    low = low.filter("low > 0 AND low * most >= modulus * 0.49D")
    amounts = low.groupBy(*BRIDGE_DAILY_KEYS, "from_chain_id", "modulus", "kind", "low").agg(F.sum("sign").alias("weight"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = [*PRICE_KEYS, "part"]
    distinct = low.select(*PRICE_KEYS, "modulus", "low").distinct().withColumn("part", F.pmod(F.hash("low"), F.lit(PRICE_PARTS)))
    priced = known.select(*PRICE_KEYS, F.col("unit").try_cast("bigint").alias("unit"), "weight")
    priced = priced.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PRICE_PARTS - 1))))
    pairs = distinct.repartition(tasks, *dealt).join(priced.repartition(tasks, *dealt), dealt)
    rounded = F.expr("weight * ((low * unit + modulus div 2) div modulus)")
    sums = pairs.groupBy(*dealt, "modulus", "low").agg(F.sum(rounded).alias("rounded")).drop("part")
    found = amounts.join(sums, [*PRICE_KEYS, "modulus", "low"])
    total = (F.col("weight").cast("decimal(18,0)") * F.col("rounded").cast("decimal(19,0)")).cast(COUNTER)
    return found.groupBy(*BRIDGE_DAILY_KEYS).agg(*[_money(F.sum(F.when(F.col("kind") == c, total))).alias(out) for c, out in USD_COLUMNS.items()])


def _far_amounts(rows: DataFrame, daily_price: DataFrame) -> DataFrame:
    """Per route the sums over amounts so large or of so many decimals that each is multiplied with each price."""
    priced = attach_role(
        rows, daily_price,
        [("from_token_symbol", "symbol"), ("from_chain_id", "chain_id"), ("timezone_type", "timezone_type"), ("bdate", "bdate")],
        {"price_usd": "price_usd"}, "price",
    )
    valued = priced.withColumn("value_eth", scale_units("value", "decimals"))
    for raw, c in USD_COLUMNS.items():
        valued = valued.withColumn(c, usd_value(raw, "price_usd", "decimals"))
        valued = valued.withColumn(f"{c}_wide", F.when(F.col(c).isNull(), usd_value_double(raw, "price_usd", "decimals")))
    valued = valued.withColumn("value_eth_wide", F.when(F.col("value_eth").isNull(), scale_units_double("value", "decimals")))
    ok = F.col("status") == 1
    wide = [F.when(ok, F.col("value_eth_wide")), F.when(ok, F.col("volume_usd_wide")), F.col("exchange_fee_usd_wide"), F.col("network_fee_usd_wide")]
    return valued.groupBy(*BRIDGE_DAILY_KEYS).agg(
        money_sum(F.when(ok, F.col("value_eth"))).alias("amount"),
        money_sum(F.when(ok, F.col("volume_usd"))).alias("volume_usd"),
        money_sum("exchange_fee_usd").alias("exchange_fee_usd"),
        money_sum("network_fee_usd").alias("network_fee_usd"),
        F.count(F.coalesce(*wide)).alias("wide_cnt"),
        *[F.sum(w).alias(f"{c}_wide") for w, c in zip(wide, ("amount", *USD_COLUMNS.values()))],
    )


def bridge_daily(details: DataFrame, daily_price: DataFrame, tokens: DataFrame, start: DateLike, end: DateLike, lookback_days: int = 1) -> DataFrame:
    """Bridge volume, counts and USD value per zone-day and route.

    Decimal totals hold every amount of up to 28 integer digits exactly. Amounts beyond
    that are counted in ``wide_cnt`` and summed as doubles in the ``*_wide`` columns.

    A transfer counts once for each price of its token and day. These pairs are not made: counts and sums are
    multiplied by the number of prices, and ``value * price`` is split at the tenth digit into a part that
    is summed on each side first and a remainder, which alone is rounded (``_rounded_parts``). Rows and distinct
    prices are checkpointed, since several sums read them.
    """
    zoned = fan_out_zones(details, shift_days(start, -lookback_days), end)
    with_dec = attach_role(
        zoned, tokens, [("from_token", "address"), ("from_chain_id", "chain_id")], {"decimals": "decimals"}, "dec"
    )
    known, totals, scale = _bridge_prices(daily_price)
    rows = attach_role(
        with_dec.select(*BRIDGE_DAILY_KEYS, "from_chain_id", "_id", "initiated_tx_hash", "finalized_tx_hash", "status", *USD_COLUMNS, "decimals"),
        totals, [(k, k) for k in PRICE_KEYS], {c: c for c in ("n_prices", "units", "units_size", "most")}, "price",
    )
    ok = F.col("status") == 1
    shift = F.col("decimals").cast("int") + (scale - MONEY_SCALE)  # digits of value * price behind the tenth
    ten = lambda n: F.pow(F.lit(10.0), n.cast("double"))
    size = lambda c: F.abs(F.col(c).cast("double"))
    far = (shift < -27) | (shift > 18) | (ten(shift) * F.greatest("most", F.lit(1.0)) > 9e18) | (F.col("units_size") > 9e18)
    for c in USD_COLUMNS:
        far = far | (size(c) * ten(-shift) > 1e31) | (size(c) * F.col("units_size") * ten(-shift) > 1e36)
    far = (far & F.col("most").isNotNull()) | (size("value") * ten(-F.col("decimals")) > 1e27)
    rows = rows.withColumn("n_prices", F.coalesce("n_prices", F.lit(1)).cast("bigint")).withColumn("far", F.coalesce(far, F.lit(False)))
    near = ~F.col("far") & F.col("units").isNotNull() & F.col("decimals").isNotNull()
    rows = rows.withColumn("modulus", F.when(near, F.concat(F.lit("1E"), F.greatest(shift, F.lit(0)).cast("string")).cast("decimal(19,0)").cast("bigint")))
    rows = rows.withColumn("up", F.when(near, F.concat(F.lit("1E"), F.greatest(-shift, F.lit(0)).cast("string")).cast("decimal(28,0)")))
    rows = materialize(rows)  # read by the three sums below
    used = {c: F.when(ok, F.col(c)) if c == "value" else F.col(c) for c in USD_COLUMNS}
    for c in USD_COLUMNS:
        whole, base = F.abs(used[c]).cast(COUNTER), F.col("modulus").cast("decimal(19,0)")
        low = F.when(near, (whole % base).cast("bigint"))
        rows = rows.withColumn(f"{c}_low", low).withColumn(f"{c}_sign", F.signum(used[c]).cast("int"))
        high = F.when(F.col("modulus") == 1, (whole * F.col("up")).cast(COUNTER)).otherwise(((whole - F.col(f"{c}_low").cast("decimal(19,0)")) / base).cast(COUNTER))
        rows = rows.withColumn(f"{c}_units", F.when(near, (high * F.col("units")).cast(COUNTER) * F.col(f"{c}_sign").cast("decimal(1,0)")).cast(COUNTER))
    times = F.col("n_prices")
    count = lambda c: F.coalesce(F.sum(F.when(c.isNotNull(), times)), F.lit(0))
    eth_units = F.concat(F.col("value").cast(COUNTER).cast("string"), F.lit("E"), (MONEY_SCALE - F.col("decimals").cast("int")).cast("string")).try_cast(COUNTER)
    rows = rows.withColumn("eth_units", F.when(ok & ~F.col("far"), eth_units))
    main = rows.groupBy(*BRIDGE_DAILY_KEYS).agg(
        count(F.col("initiated_tx_hash")).alias("initiated_cnt"),
        count(F.col("finalized_tx_hash")).alias("finalized_cnt"),
        count(F.when(ok, F.col("_id"))).alias("success_cnt"),
        count(F.when(F.col("status") != 1, F.col("_id"))).alias("failed_cnt"),
        F.count_distinct("initiated_tx_hash").alias("tx_cnt"),
        _money(F.sum((F.col("eth_units") * times.cast("decimal(10,0)")).cast(COUNTER))).alias("amount"),
        *[F.sum((F.col(c) * times.cast("decimal(10,0)")).cast(COUNTER)).alias(c) for c in ("exchange_fee", "network_fee")],
        *[_money(F.sum(f"{c}_units")).alias(out) for c, out in USD_COLUMNS.items()],
    )
    parts = main.unionByName(_rounded_parts(rows.filter(near), known), allowMissingColumns=True)
    parts = parts.unionByName(_far_amounts(rows.filter("far"), daily_price), allowMissingColumns=True)
    return parts.groupBy(*BRIDGE_DAILY_KEYS).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("initiated_cnt", "finalized_cnt", "success_cnt", "failed_cnt", "tx_cnt")],
        money_sum("amount").alias("amount"),
        money_sum("volume_usd").alias("volume_usd"),
        F.sum("exchange_fee").cast(COUNTER).alias("exchange_fee"),
        money_sum("exchange_fee_usd").alias("exchange_fee_usd"),
        F.sum("network_fee").cast(COUNTER).alias("network_fee"),
        money_sum("network_fee_usd").alias("network_fee_usd"),
        F.coalesce(F.sum("wide_cnt"), F.lit(0)).alias("wide_cnt"),
        *[F.coalesce(F.sum(f"{c}_wide"), F.lit(0.0)).alias(f"{c}_wide") for c in ("amount", *USD_COLUMNS.values())],
    )


# D10 ------------------------------------------------------------------------
STAT_COUNTERS = [
    "total_blocks", "total_transactions", "total_addresses", "total_gas_used", "transactions_today",
    "market_cap", "gas_used_today",
]


def chain_stats_daily(stats: DataFrame, start: DateLike, end: DateLike, tie_cols=("ts_utc",)) -> DataFrame:
    """One stats sample per zone-day, the one closest to midnight.

    Reads one day past ``end`` (I3) because the 00:00-00:04 samples of the
    next day close the last day, then clips back to ``[start, end)`` (P8).
    """
    zoned = fan_out_zones(stats, start, shift_days(end, 1))
    picked = clip_days(closest_to_midnight(zoned, tie_cols), start, end)
    for c in STAT_COUNTERS:
        picked = picked.withColumn(c, F.col(c).cast(COUNTER))
    return picked
