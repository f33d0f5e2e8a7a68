"""Oracle SQL (DuckDB dialect) for every registered query that SQL can state.

The bindings of ``plans/bindings.py`` are restated as CTEs, and each query is
written in its plain textbook form (two filtered copies + UNION ALL for the
zones, self joins for WAU/MAU, ROW_NUMBER for the midnight pick), so the
Spark rewrites are checked against the naive semantics.
"""

from __future__ import annotations

from martforge.plans import queries as Q
from martforge.sources.scans import _epoch


def H(x: str) -> str:
    """F1 in SQL."""
    return f"lower('0x' || hex({x}))"


def TS(d) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def D(d) -> str:
    return f"DATE '{d.isoformat()}'"


def from_epoch(x: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({x}))"


def epoch(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


def zone_cols(ts: str) -> str:
    kst = f"({ts} + INTERVAL 9 HOUR)"
    return f"{ts} AS ts_utc, CAST({ts} AS DATE) AS dt_utc, {kst} AS ts_kst, CAST({kst} AS DATE) AS dt_kst"


MONEY = "DECIMAL(38,10)"
Q4, Q6 = "DECIMAL(18,4)", "DECIMAL(18,6)"  # declared binding money types

# --- binding CTEs ---------------------------------------------------------------
ORDERS_TS = "orders_ts AS (SELECT *, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS ts FROM orders)"

TOKENS = f"""tokens AS (SELECT CAST(n_nationkey AS BIGINT) AS _id, CAST(n_nationkey % 5 AS BIGINT) AS chain_id,
  {H('CAST(n_nationkey AS BIGINT)')} AS address, n_name AS name, 'TK' || CAST(n_nationkey AS VARCHAR) AS symbol,
  CAST(n_nationkey % 19 AS INTEGER) AS decimals FROM nation)"""

PAIRS = f"""pairs AS (SELECT {H('s_suppkey')} AS pair_address, s_name AS pair_name,
  {H('CAST((s_nationkey + 1) % 25 AS BIGINT)')} AS quote_address, {H('CAST(s_nationkey AS BIGINT)')} AS base_address,
  CAST(((s_nationkey + 1) % 25) % 19 AS INTEGER) AS quote_decimals, CAST(s_nationkey % 19 AS INTEGER) AS base_decimals,
  s_suppkey * 3600 AS open_time, CAST(s_acctbal AS DECIMAL(12,2)) AS open_price FROM supplier)"""

CHAINS = "chains AS (SELECT CAST(r_regionkey AS BIGINT) AS chain_id, r_name AS network FROM region)"

ORDER_COLS = (
    "idx, pair_address, order_id, owner, order_side, price, amount, volume, filled, filled_volume, price_usd_at, "
    "volume_usd_at, filled_usd_at, created_at, created_block, created_hash, closed_type, closed_at, closed_block, closed_hash"
)

ORDER_ROWS = f"""order_base AS (
  SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS p, CAST((o_orderkey % 9) + 1 AS DECIMAL(10,2)) AS a,
    CASE WHEN o_orderstatus = 'F' THEN CAST((o_orderkey % 9) + 1 AS DECIMAL(10,2))
         WHEN o_orderstatus = 'P' THEN CAST(1 AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END AS f,
    {epoch('ts')} AS created
  FROM orders_ts),
order_rows AS (
  SELECT o_orderkey AS idx, {H('o_orderkey % 50')} AS pair_address, o_orderkey AS order_id, {H('o_custkey')} AS owner,
    CAST(o_orderkey % 2 AS INTEGER) AS order_side, p AS price, a AS amount, CAST(p * a AS {Q4}) AS volume, f AS filled,
    CAST(f * p AS {Q4}) AS filled_volume, p AS price_usd_at, CAST(p * a AS {Q4}) AS volume_usd_at,
    CAST(f * p AS {Q4}) AS filled_usd_at,
    created AS created_at, o_orderkey AS created_block, {H('o_orderkey * 3')} AS created_hash,
    CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '5-LOW' THEN NULL ELSE 2 END AS INTEGER) AS closed_type,
    created + (o_orderkey % 5) * 15 * 86400 + 3600 AS closed_at, o_orderkey + 1000 AS closed_block,
    {H('o_orderkey * 3 + 1')} AS closed_hash, o_orderstatus
  FROM order_base)"""


def landed_snapshot(end) -> str:
    return f"""snapshot AS (SELECT {ORDER_COLS}, {zone_cols(from_epoch('created_at'))}
  FROM order_rows WHERE created_at < {_epoch(end)})"""


LANDED_CLOSED = f"""closed AS (SELECT {ORDER_COLS}, {zone_cols(from_epoch('closed_at'))}
  FROM order_rows WHERE o_orderstatus = 'F' AND closed_at >= {_epoch(Q.ALL_START)} AND closed_at < {_epoch(Q.ALL_END)})"""

FILLS = f"""fills AS (
  SELECT l_orderkey * 8 + l_linenumber AS idx, {H('l_suppkey')} AS pair_address, l_orderkey AS order_id,
    {H('o_custkey')} AS owner, CAST(l_linenumber % 2 AS INTEGER) AS order_side,
    CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_taker,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS amount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(10,2)) AS {Q4}) AS volume,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS {Q4}) AS fee,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS {Q4}) AS price_usd_at,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS {Q6}) AS volume_usd_at,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS {Q6}) AS fee_usd_at,
    {epoch('ts')} AS time_utc, l_orderkey AS block, {H('l_orderkey')} AS hash
  FROM lineitem JOIN orders_ts ON l_orderkey = o_orderkey)"""

LANDED_FILLS = f"""lfills AS (SELECT *, {zone_cols(from_epoch('time_utc'))} FROM fills
  WHERE time_utc >= {_epoch(Q.ALL_START)} AND time_utc < {_epoch(Q.ALL_END)})"""

FEE_ROWS = f"""fee_rows AS (
  SELECT l_orderkey * 8 + l_linenumber AS idx, {H('l_suppkey')} AS pair_address, l_orderkey AS order_id,
    {H('l_partkey')} AS owner, CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount, {H('l_suppkey % 7')} AS recipient,
    CAST(l_linenumber * 5 AS INTEGER) AS fee_bps,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS {Q4}) AS fee,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS {Q4}) AS fee_usd_at,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS {Q4}) AS {Q4}) AS net_amount,
    l_orderkey AS block, {H('l_orderkey * 8 + l_linenumber')} AS hash
  FROM lineitem)"""


def landed_fees(start, end) -> str:
    return f"""lfees AS (
  SELECT f.*, t.time_utc, {zone_cols(from_epoch('t.time_utc'))}
  FROM fee_rows f LEFT JOIN (SELECT DISTINCT block, time_utc FROM fills) t ON f.block = t.block
  WHERE t.time_utc >= {_epoch(start)} AND t.time_utc < {_epoch(end)})"""


TRANSFERS = f"""transfers AS (
  SELECT event_id AS _id, user_id % 5 AS from_chain_id, (user_id + event_id) % 7 AS to_chain_id, event_id AS "index",
    {H('user_id % 25')} AS from_token, {H('(user_id + 3) % 25')} AS to_token, {H('user_id')} AS "from",
    {H('user_id + 1')} AS "to", CAST(CAST(CAST(value AS DECIMAL(12,2)) * 100 AS HUGEINT) * CAST(rpad('1', CAST(event_id % 12 + 1 AS INTEGER), '0') AS HUGEINT) AS DECIMAL(38,0)) AS value,
    CAST(event_id % 1000 AS DECIMAL(38,0)) AS exchange_fee, CAST(user_id % 100 + 1 AS DECIMAL(38,0)) AS network_fee,
    {H('event_id % 16')} AS extra_data, {H('event_id')} AS initiated_tx_hash,
    CASE WHEN event_type = 'error' THEN NULL ELSE {H('event_id + 1000000000')} END AS finalized_tx_hash,
    {epoch('ts')} AS initiated_time,
    CASE WHEN event_type = 'error' THEN NULL ELSE {epoch('ts')} + 600 END AS finalized_time,
    CAST(CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'signup' THEN NULL ELSE 1 END AS INTEGER) AS status
  FROM events),
ltransfers AS (SELECT *, {zone_cols(from_epoch('initiated_time'))} FROM transfers
  WHERE initiated_time >= {_epoch(Q.EV_START)} AND initiated_time < {_epoch(Q.EV_END)})"""

PRICE_TIME = f"({epoch('ts')} - {epoch('ts')} % 86400 + [0, 6, 15, 18][CAST((event_id // 2) % 4 + 1 AS INTEGER)] * 3600 + (event_id % 2) * 1800)"
PRICES = f"""prices AS (
  SELECT * FROM (
    SELECT event_id AS _id, user_id % 5 AS chain_id, {H('user_id % 25')} AS address,
      CAST(value AS DECIMAL(12,2)) AS price_usd, CAST(event_id % 3 AS INTEGER) AS interval_flags,
      {PRICE_TIME} AS updated_at, {zone_cols(from_epoch(PRICE_TIME))}
    FROM events WHERE {PRICE_TIME} >= {_epoch(Q.EV_START)} AND {PRICE_TIME} < {_epoch(Q.EV_END)})
  WHERE minute(ts_utc) = 0)"""

MIDNIGHT_PRICE = f"""zprice AS (
  SELECT *, 'utc' AS timezone_type, dt_utc AS bdate FROM prices
   WHERE dt_utc >= {D(Q.EV_START)} AND dt_utc < {D(Q.EV_END)} AND hour(ts_utc) = 0
  UNION ALL
  SELECT *, 'kst' AS timezone_type, dt_kst AS bdate FROM prices
   WHERE dt_kst >= {D(Q.EV_START)} AND dt_kst < {D(Q.EV_END)} AND hour(ts_kst) = 0),
mprice AS (
  SELECT z.timezone_type, CAST(z.bdate - INTERVAL 1 DAY AS DATE) AS bdate, z.ts_utc, z.ts_kst, z.chain_id, z.address,
    t.symbol, t.decimals, z.price_usd
  FROM zprice z LEFT JOIN tokens t ON z.address = t.address AND z.chain_id = t.chain_id)"""

STATS = f"""lstats AS (
  SELECT event_id, value AS average_block_time, value AS coin_price, CAST(user_id AS DOUBLE) AS gas_prices_average,
    CAST(user_id AS INTEGER) AS total_addresses, event_id * 10 AS total_blocks, event_id * 100 + user_id AS total_transactions,
    event_id * 21000 AS total_gas_used, user_id AS transactions_today, event_id + 1000000 AS market_cap,
    user_id * 21000 AS gas_used_today, event_id AS tvl, ts, {zone_cols('ts')}
  FROM events WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)})"""


def scaled(digits: str, places: str) -> str:
    """Text of an integer (no sign) times 10 ** -places as DECIMAL(38,10), rounded half up; NULL if too wide.

    The last ``places - 10`` digits are cut and the first of them decides the rounding; fewer places
    append zeros. No step narrows the number.
    """
    padded = f"(repeat('0', 50) || ({digits}) || repeat('0', CAST(greatest(10 - ({places}), 0) AS INTEGER)))"
    drop = f"CAST(greatest(({places}) - 10, 0) AS INTEGER)"
    kept = f"ltrim(left({padded}, length({padded}) - {drop}), '0')"
    first = f"(CASE WHEN {drop} > 0 THEN substr({padded}, length({padded}) - {drop} + 1, 1) ELSE '0' END)"
    whole = f"(CASE WHEN length({kept}) <= 38 THEN CAST(('0' || {kept}) AS HUGEINT) + (CASE WHEN {first} >= '5' THEN 1 ELSE 0 END) END)"
    text = f"lpad(CAST({whole} AS VARCHAR), 40, '0')"
    return f"TRY_CAST(left({text}, 30) || '.' || right({text}, 10) AS {MONEY})"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + BODY_MARK + body


BODY_MARK = "-- body\n"


def _body(sql: str) -> str:
    """The final SELECT of a query built by ``with_ctes``."""
    return sql.split(BODY_MARK, 1)[1]


def zones_union(src: str, start, end, extra: str = "") -> str:
    """P5 naive: two filtered copies and UNION ALL; ``bdate`` replaces dt_*."""
    lo_u = f"dt_utc >= {D(start)} AND " if start is not None else ""
    lo_k = f"dt_kst >= {D(start)} AND " if start is not None else ""
    return f"""SELECT * EXCLUDE (dt_utc, dt_kst), 'utc' AS timezone_type, dt_utc AS bdate FROM {src}
  WHERE {lo_u}dt_utc < {D(end)} {extra}
UNION ALL
SELECT * EXCLUDE (dt_utc, dt_kst), 'kst' AS timezone_type, dt_kst AS bdate FROM {src}
  WHERE {lo_k}dt_kst < {D(end)} {extra}"""


ORDER_DETAILS = f"""done AS (SELECT *, 1 AS is_completed FROM closed WHERE dt_utc < {D(Q.ALL_END)}),
live AS (SELECT *, 0 AS is_completed FROM snapshot WHERE dt_utc < {D(Q.ALL_END)}),
both_orders AS (
  SELECT * FROM done
  UNION ALL BY NAME
  SELECT * FROM live l WHERE NOT EXISTS (
    SELECT 1 FROM done c WHERE c.order_id = l.order_id AND c.pair_address = l.pair_address)),
details AS (
  SELECT a.dt_utc, a.dt_kst, a.ts_utc, a.ts_kst, a.order_id, a.created_block, a.created_hash, a.is_completed,
    a.closed_type, a.closed_at, a.closed_block, a.closed_hash, b.pair_name, a.pair_address, b.quote_address,
    d.name AS quote_name, d.symbol AS quote_symbol, b.base_address, c.name AS base_name, c.symbol AS base_symbol,
    a.owner, a.order_side, a.price, a.price_usd_at AS price_usd, CAST(a.price_usd_at * a.amount AS DECIMAL(23,4)) AS amount_usd, a.amount,
    a.filled, a.filled_usd_at AS filled_usd, a.volume, a.volume_usd_at AS volume_usd, a.filled_volume,
    a.filled_usd_at AS filled_volume_usd
  FROM both_orders a LEFT JOIN pairs b ON a.pair_address = b.pair_address
  LEFT JOIN tokens c ON b.base_address = c.address
  LEFT JOIN tokens d ON b.quote_address = d.address)"""

ORDER_DETAIL_CTES = (ORDERS_TS, TOKENS, PAIRS, ORDER_ROWS, landed_snapshot(Q.ALL_END), LANDED_CLOSED, ORDER_DETAILS)

TRADE_DETAILS = f"""tdetails AS (
  SELECT a.dt_utc, a.dt_kst, a.ts_utc, a.ts_kst, a.block, a.time_utc AS block_time, a.hash AS txhash, a.idx,
    b.pair_name, a.pair_address, b.quote_address, d.name AS quote_name, d.symbol AS quote_symbol, b.base_address,
    c.name AS base_name, c.symbol AS base_symbol, a.owner, a.order_side, a.is_taker, a.price,
    a.price_usd_at AS price_usd, a.amount, a.volume, a.volume_usd_at AS volume_usd, a.fee, a.fee_usd_at AS fee_usd
  FROM lfills a LEFT JOIN pairs b ON a.pair_address = b.pair_address
  LEFT JOIN tokens c ON b.base_address = c.address
  LEFT JOIN tokens d ON b.quote_address = d.address
  WHERE a.dt_utc >= {D(Q.ALL_START)} AND a.dt_utc < {D(Q.ALL_END)})"""

TRADE_CTES = (ORDERS_TS, TOKENS, PAIRS, FILLS, LANDED_FILLS, TRADE_DETAILS)

BRIDGE_DETAILS = f"""bdetails AS (
  SELECT a.dt_utc, a.dt_kst, a.ts_utc, a.ts_kst, a.initiated_time, a.finalized_time, a._id, a.from_chain_id,
    b.network AS from_chain_name, a.to_chain_id, c.network AS to_chain_name, a."index", a.from_token,
    d.symbol AS from_token_symbol, a.to_token, e.symbol AS to_token_symbol, a."from", a."to", a.value,
    a.exchange_fee, a.network_fee, a.extra_data, a.initiated_tx_hash, a.finalized_tx_hash, a.status
  FROM ltransfers a
  LEFT JOIN chains b ON a.from_chain_id = b.chain_id
  LEFT JOIN chains c ON a.to_chain_id = c.chain_id
  LEFT JOIN tokens d ON a.from_token = d.address AND a.from_chain_id = d.chain_id
  LEFT JOIN tokens e ON a.to_token = e.address AND a.to_chain_id = e.chain_id
  WHERE a.dt_utc >= {D(Q.EV_START)} - INTERVAL 1 DAY AND a.dt_utc < {D(Q.EV_END)})"""


def activity_ctes() -> tuple:
    zoned = zones_union("details", None, Q.ALL_END)
    return ORDER_DETAIL_CTES + (
        f"zoned AS ({zoned})",
        "act AS (SELECT DISTINCT timezone_type, CAST(bdate AS DATE) AS bdate, owner FROM zoned)",
    )


DAU = "dau AS (SELECT timezone_type, bdate, count(DISTINCT owner) AS dau FROM act GROUP BY 1, 2)"
WAU = """wau AS (SELECT a.timezone_type, a.bdate, count(DISTINCT b.owner) AS wau
  FROM act a JOIN act b ON a.timezone_type = b.timezone_type
   AND b.bdate BETWEEN a.bdate AND CAST(a.bdate + INTERVAL 6 DAY AS DATE)
  GROUP BY 1, 2)"""
MAU = """mau AS (SELECT a.timezone_type, a.bdate, count(DISTINCT b.owner) AS mau
  FROM act a JOIN act b ON a.timezone_type = b.timezone_type
   AND b.bdate BETWEEN date_trunc('month', a.bdate) AND last_day(a.bdate)
  GROUP BY 1, 2)"""
RU = """ru AS (SELECT a.timezone_type, a.bdate, count(DISTINCT b.owner) AS ru
  FROM (SELECT DISTINCT timezone_type, bdate FROM act) a JOIN act b
    ON a.timezone_type = b.timezone_type AND b.bdate <= a.bdate
  GROUP BY 1, 2)"""
NRU = """nru AS (SELECT timezone_type, first_visit AS bdate, count(DISTINCT owner) AS nru
  FROM (SELECT owner, timezone_type, min(bdate) AS first_visit FROM act GROUP BY 1, 2) GROUP BY 1, 2)"""


def event_daily(start, end, drop_errors: bool) -> str:
    ev = f"""SELECT event_id, user_id, event_type, value, ts, {zone_cols('ts')} FROM events
  WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)}"""
    extra = "AND event_type <> 'error'" if drop_errors else ""
    return f"""SELECT timezone_type, bdate, event_type, count(*) AS events,
  CAST(sum(CAST(value AS DECIMAL(12,2))) AS {MONEY}) AS value
FROM ({zones_union(f'({ev})', start, end, extra)}) GROUP BY 1, 2, 3"""


RUN1 = event_daily(Q.RUN1_START, Q.RUN1_END, False)
RUN2 = event_daily(Q.RUN2_START, Q.RUN2_END, True)

LANDED_EVENTS = f"""SELECT event_id, user_id, event_type, value, ts, {zone_cols('ts')} FROM events
  WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)}"""


def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["scan_time_slice"] = f"""SELECT event_id, user_id, event_type, value, ts, {zone_cols('ts')} FROM events
WHERE ts >= {TS(Q.SLICE_START)} AND ts < {TS(Q.SLICE_END)}"""
    s["scan_until"] = with_ctes(ORDERS_TS, ORDER_ROWS, landed_snapshot(Q.UNTIL_END), body="SELECT * FROM snapshot")
    s["scan_projection"] = with_ctes(PAIRS, body="SELECT * FROM pairs")
    s["scan_extra_predicate"] = with_ctes(PRICES, body="SELECT * FROM prices")
    s["scan_borrow_timestamp"] = with_ctes(
        ORDERS_TS, FILLS, FEE_ROWS, landed_fees(Q.ALL_START, Q.ALL_END), body="SELECT * FROM lfees"
    )
    s["scan_partition_list"] = f"""SELECT * FROM ({LANDED_EVENTS}) WHERE dt_utc >= {D(Q.SLICE_START)} AND dt_utc < {D(Q.SLICE_END)}"""
    s["hex_normalise"] = f"""SELECT s_suppkey, {H('s_suppkey')} AS suppkey_hex, {H('s_name')} AS name_hex,
  lower('0xAbC' || hex(s_suppkey)) AS hash_lower FROM supplier"""
    s["dual_zone_columns"] = f"SELECT event_id, ts, {zone_cols('ts')} FROM events"
    s["dual_zone_rows"] = f"""SELECT event_id, user_id, timezone_type, bdate, ts_utc, ts_kst, value FROM (
{zones_union(f"(SELECT event_id, user_id, value, {zone_cols('ts')} FROM events)", Q.EV_START, Q.EV_END)})"""

    # JSON ingest: expected typed values straight from the source columns
    s["json_items_explode"] = f"""SELECT event_id, {H('event_id')} AS address, CAST(value AS DECIMAL(38,2)) AS circulating_market_cap,
  CAST(user_id % 19 AS INTEGER) AS decimals, CAST(value AS DECIMAL(38,2)) AS exchange_rate, CAST(user_id AS INTEGER) AS holders,
  event_type AS name, upper(event_type) AS symbol, CAST(event_id * 1000 AS DECIMAL(38,0)) AS total_supply,
  'ERC-20' AS type, CAST(value AS DECIMAL(38,2)) AS volume_24h FROM events
UNION ALL
SELECT event_id, {H('event_id + 1000000000')} AS address, NULL AS circulating_market_cap, TRY_CAST(event_type AS INTEGER) AS decimals,
  NULL AS exchange_rate, TRY_CAST(event_id AS INTEGER) AS holders, 'junk' AS name, NULL AS symbol, NULL AS total_supply,
  'ERC-721' AS type, NULL AS volume_24h FROM events"""
    lt = Q.LOAD_TS
    stamp = f"TIMESTAMP '{lt.isoformat(sep=' ')}'"
    s["json_flatten"] = f"""SELECT event_id, CAST({stamp} AS DATE) AS dt_utc, {stamp} AS ts_utc,
  CAST({stamp} + INTERVAL 9 HOUR AS DATE) AS dt_kst, {stamp} + INTERVAL 9 HOUR AS ts_kst,
  value AS average_block_time, value AS coin_price, CAST(user_id - 50 AS DOUBLE) AS coin_price_change_percentage,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS gas_price_updated_at, CAST(user_id AS DOUBLE) AS gas_prices_slow,
  CAST(user_id * 2 AS DOUBLE) AS gas_prices_average, CAST(user_id * 3 AS DOUBLE) AS gas_prices_fast,
  event_id AS gas_prices_update_in, user_id * 21000 AS gas_used_today, event_id + 1000000 AS market_cap,
  value AS network_utilization_percentage, CAST(NULL AS DOUBLE) AS secondary_coin_price,
  TRY_CAST(event_type AS DOUBLE) AS static_gas_price, CAST(user_id AS INTEGER) AS total_addresses,
  event_id * 10 AS total_blocks, event_id * 21000 AS total_gas_used, event_id * 100 + user_id AS total_transactions,
  user_id AS transactions_today, event_id AS tvl FROM events"""
    s["json_contracts"] = f"""SELECT s_suppkey, s_name AS name, lower('0xAbC' || hex(s_suppkey)) AS address,
  '0xAbC' || hex(s_suppkey) AS hash, '2024-01-' || lpad(CAST((s_suppkey % 28) + 1 AS VARCHAR), 2, '0') AS verified_at
FROM supplier"""
    s["safe_numeric_casts"] = """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
  TRY_CAST(event_type AS INTEGER) AS type_int, CAST(value AS DECIMAL(38,2)) AS value_dec,
  CAST(NULL AS INTEGER) AS junk_int, CAST(event_id * 1000 AS DECIMAL(38,0)) AS supply_dec FROM events"""

    # marts
    s["order_details"] = with_ctes(*ORDER_DETAIL_CTES, body="SELECT * FROM details")
    s["order_daily"] = with_ctes(
        *ORDER_DETAIL_CTES,
        f"zoned AS ({zones_union('details', None, Q.ALL_END)})",
        body=f"""SELECT timezone_type, bdate, pair_name, pair_address, quote_address, quote_name, quote_symbol,
  base_address, base_name, base_symbol, owner, order_side,
  CASE WHEN closed_type = 0 THEN 0 ELSE 1 END AS is_cancelled,
  CAST(sum(price) AS DOUBLE) / count(price) AS avg_price, CAST(sum(price_usd) AS DOUBLE) / count(price_usd) AS avg_price_usd,
  CAST(sum(amount) AS {MONEY}) AS amount, CAST(sum(amount_usd) AS {MONEY}) AS amount_usd,
  CAST(sum(filled) AS {MONEY}) AS filled, CAST(sum(filled_usd) AS {MONEY}) AS filled_usd,
  CAST(sum(volume) AS {MONEY}) AS volume, CAST(sum(volume_usd) AS {MONEY}) AS volume_usd,
  CAST(sum(filled_volume) AS {MONEY}) AS filled_volume, CAST(sum(filled_volume_usd) AS {MONEY}) AS filled_volume_usd
FROM zoned GROUP BY ALL""",
    )
    s["trade_details"] = with_ctes(*TRADE_CTES, body="SELECT * FROM tdetails")
    s["trade_daily"] = with_ctes(
        *TRADE_CTES,
        f"zoned AS ({zones_union('tdetails', Q.ALL_START, Q.ALL_END)})",
        body=f"""SELECT timezone_type, bdate, pair_name, base_symbol, quote_symbol, count(DISTINCT txhash) AS tx_cnt,
  CAST(min(price) AS {MONEY}) AS low_price, CAST(max(price) AS {MONEY}) AS high_price,
  CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
  CAST(sum(amount) AS {MONEY}) AS amount, CAST(sum(volume) AS {MONEY}) AS volume,
  CAST(sum(volume_usd) AS {MONEY}) AS volume_usd, CAST(sum(fee) AS {MONEY}) AS fee, CAST(sum(fee_usd) AS {MONEY}) AS fee_usd
FROM zoned WHERE is_taker = 1 GROUP BY 1, 2, 3, 4, 5""",
    )
    s["fee_daily"] = with_ctes(
        ORDERS_TS, TOKENS, PAIRS, FILLS, FEE_ROWS, landed_fees(Q.ALL_START, Q.ALL_END),
        f"zoned AS ({zones_union('lfees', Q.ALL_START, Q.ALL_END)})",
        body=f"""SELECT a.timezone_type, a.bdate, b.pair_name, a.pair_address, d.address AS quote_address, d.name AS quote_name,
  d.symbol AS quote_symbol, c.address AS base_address, c.name AS base_name, c.symbol AS base_symbol, a.recipient,
  CAST(sum(a.gross_amount) AS {MONEY}) AS gross_amount, CAST(sum(a.net_amount) AS {MONEY}) AS net_amount,
  CAST(sum(a.fee) AS {MONEY}) AS fee
FROM zoned a LEFT JOIN pairs b ON a.pair_address = b.pair_address
LEFT JOIN tokens c ON b.base_address = c.address
LEFT JOIN tokens d ON b.quote_address = d.address
GROUP BY ALL""",
    )
    s["order_matches_daily"] = with_ctes(
        ORDERS_TS, TOKENS, PAIRS, FILLS, LANDED_FILLS,
        f"zoned AS ({zones_union('lfills', Q.ALL_START, Q.ALL_END)})",
        f"""agg AS (SELECT timezone_type, bdate, pair_address, order_side, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
  CAST(sum(amount) AS {MONEY}) AS total_amount, CAST(sum(fee) AS {MONEY}) AS total_fee, max(block) AS last_block
  FROM zoned GROUP BY 1, 2, 3, 4)""",
        body="""SELECT a.timezone_type, a.bdate, p.pair_name, a.pair_address, c.name AS quote_name, c.symbol AS quote_symbol,
  p.quote_address, b.name AS base_name, b.symbol AS base_symbol, p.base_address, a.order_side, a.avg_price,
  a.total_amount, a.total_fee, a.last_block
FROM agg a LEFT JOIN pairs p ON a.pair_address = p.pair_address
LEFT JOIN tokens b ON p.base_address = b.address
LEFT JOIN tokens c ON p.quote_address = c.address""",
    )
    s["open_order_tvl"] = with_ctes(
        *ORDER_DETAIL_CTES,
        f"zoned AS ({zones_union('(SELECT * FROM details WHERE is_completed = 0)', None, Q.ALL_END)})",
        body=f"""SELECT timezone_type, bdate, pair_name, base_symbol, quote_symbol,
  CAST(coalesce(sum(CASE WHEN order_side = 0 THEN CAST(amount - filled AS {MONEY}) END), 0) AS {MONEY}) AS tvl_base,
  CAST(coalesce(sum(CASE WHEN order_side = 0 THEN CAST((amount - filled) * price_usd AS {MONEY}) END), 0) AS {MONEY}) AS tvl_base_usd,
  CAST(coalesce(sum(CASE WHEN order_side = 1 THEN CAST(volume - filled_volume AS {MONEY}) END), 0) AS {MONEY}) AS tvl_quote,
  CAST(coalesce(sum(CASE WHEN order_side = 1 THEN CAST(volume_usd - filled_volume_usd AS {MONEY}) END), 0) AS {MONEY}) AS tvl_quote_usd,
  CAST(coalesce(sum(CASE WHEN order_side = 0 THEN CAST((amount - filled) * price_usd AS {MONEY}) END), 0)
     + coalesce(sum(CASE WHEN order_side = 1 THEN CAST(volume_usd - filled_volume_usd AS {MONEY}) END), 0) AS {MONEY}) AS tvl_usd
FROM zoned GROUP BY 1, 2, 3, 4, 5""",
    )
    s["trade_daily_with_tvl"] = with_ctes(
        *ORDER_DETAIL_CTES, FILLS, LANDED_FILLS, TRADE_DETAILS,
        f"tzoned AS ({zones_union('tdetails', Q.ALL_START, Q.ALL_END)})",
        f"""trades AS ({_body(s["trade_daily"]).replace("FROM zoned", "FROM tzoned")})""",
        f"ozoned AS ({zones_union('(SELECT * FROM details WHERE is_completed = 0)', None, Q.ALL_END)})",
        f"""tvl AS ({_body(s["open_order_tvl"]).replace("FROM zoned", "FROM ozoned")})""",
        body=f"""SELECT t.*, CAST(coalesce(v.tvl_base, 0) AS {MONEY}) AS tvl_base,
  CAST(coalesce(v.tvl_base_usd, 0) AS {MONEY}) AS tvl_base_usd, CAST(coalesce(v.tvl_quote, 0) AS {MONEY}) AS tvl_quote,
  CAST(coalesce(v.tvl_quote_usd, 0) AS {MONEY}) AS tvl_quote_usd, CAST(coalesce(v.tvl_usd, 0) AS {MONEY}) AS tvl_usd
FROM trades t LEFT JOIN tvl v USING (timezone_type, bdate, pair_name, base_symbol, quote_symbol)""",
    )
    s["bridge_details"] = with_ctes(TOKENS, CHAINS, TRANSFERS, BRIDGE_DETAILS, body="SELECT * FROM bdetails")
    lb = Q.EV_START  # D9 reads one look-back day before the slice
    usd = "(CAST({} AS HUGEINT) * CAST(b.price_usd * 100 AS HUGEINT))"
    s["bridge_daily"] = with_ctes(
        TOKENS, CHAINS, TRANSFERS, BRIDGE_DETAILS, PRICES, MIDNIGHT_PRICE,
        f"""zoned AS (
SELECT * EXCLUDE (dt_utc, dt_kst), 'utc' AS timezone_type, dt_utc AS bdate FROM bdetails
  WHERE dt_utc >= {D(lb)} - INTERVAL 1 DAY AND dt_utc < {D(Q.EV_END)}
UNION ALL
SELECT * EXCLUDE (dt_utc, dt_kst), 'kst' AS timezone_type, dt_kst AS bdate FROM bdetails
  WHERE dt_kst >= {D(lb)} - INTERVAL 1 DAY AND dt_kst < {D(Q.EV_END)})""",
        f"""valued AS (
  SELECT a.*, b.price_usd, c.decimals,
    {scaled('CAST(a.value AS HUGEINT)', 'c.decimals')} AS value_eth,
    {scaled(usd.format('a.value'), 'c.decimals + 2')} AS volume_usd,
    {scaled(usd.format('a.exchange_fee'), 'c.decimals + 2')} AS exchange_fee_usd,
    {scaled(usd.format('a.network_fee'), 'c.decimals + 2')} AS network_fee_usd
  FROM zoned a
  LEFT JOIN tokens c ON a.from_token = c.address AND a.from_chain_id = c.chain_id
  LEFT JOIN mprice b ON a.from_token_symbol = b.symbol AND a.from_chain_id = b.chain_id
    AND a.timezone_type = b.timezone_type AND a.bdate = b.bdate)""",
        body=f"""SELECT timezone_type, bdate, from_chain_name, to_chain_name, from_token_symbol, to_token_symbol,
  count(initiated_tx_hash) AS initiated_cnt, count(finalized_tx_hash) AS finalized_cnt,
  count(CASE WHEN status = 1 THEN _id END) AS success_cnt, count(CASE WHEN status <> 1 THEN _id END) AS failed_cnt,
  count(DISTINCT initiated_tx_hash) AS tx_cnt,
  CAST(sum(CASE WHEN status = 1 THEN value_eth END) AS {MONEY}) AS amount,
  CAST(sum(CASE WHEN status = 1 THEN volume_usd END) AS {MONEY}) AS volume_usd,
  CAST(sum(exchange_fee) AS DECIMAL(38,0)) AS exchange_fee, CAST(sum(exchange_fee_usd) AS {MONEY}) AS exchange_fee_usd,
  CAST(sum(network_fee) AS DECIMAL(38,0)) AS network_fee, CAST(sum(network_fee_usd) AS {MONEY}) AS network_fee_usd,
  CAST(0 AS BIGINT) AS wide_cnt, CAST(0 AS DOUBLE) AS amount_wide, CAST(0 AS DOUBLE) AS volume_usd_wide,
  CAST(0 AS DOUBLE) AS exchange_fee_usd_wide, CAST(0 AS DOUBLE) AS network_fee_usd_wide
FROM valued GROUP BY 1, 2, 3, 4, 5, 6""",
    )
    s["bridge_stream"] = s["bridge_daily"]
    s["midnight_price"] = with_ctes(TOKENS, PRICES, MIDNIGHT_PRICE, body="SELECT * FROM mprice")
    dist = """CASE WHEN h = 0 AND m = 0 THEN 0 WHEN h = 0 THEN m WHEN h = 23 THEN 60 - m
      WHEN h = 14 THEN 60 - m + 600 WHEN h = 15 THEN m + 600 ELSE 9999 END"""
    s["closest_to_midnight"] = with_ctes(
        STATS,
        f"zoned AS ({zones_union('lstats', Q.EV_START, Q.EV_END + __import__('datetime').timedelta(days=1))})",
        """clocked AS (SELECT *, CASE WHEN timezone_type = 'utc' THEN ts_utc ELSE ts_kst END AS zts FROM zoned)""",
        """hm AS (SELECT *, hour(zts) AS h, minute(zts) AS m FROM clocked)""",
        f"""ranked AS (SELECT *,
    CASE WHEN h = 0 AND m < 5 THEN CAST(bdate - INTERVAL 1 DAY AS DATE) ELSE bdate END AS adj,
    row_number() OVER (PARTITION BY timezone_type,
       CASE WHEN h = 0 AND m < 5 THEN CAST(bdate - INTERVAL 1 DAY AS DATE) ELSE bdate END
       ORDER BY {dist}, ts_utc, event_id) AS rn
  FROM hm)""",
        body=f"""SELECT timezone_type, adj AS bdate, event_id, ts, ts_utc, ts_kst, average_block_time, coin_price,
  gas_prices_average, CAST(total_addresses AS DECIMAL(38,0)) AS total_addresses,
  CAST(total_blocks AS DECIMAL(38,0)) AS total_blocks, CAST(total_transactions AS DECIMAL(38,0)) AS total_transactions,
  CAST(total_gas_used AS DECIMAL(38,0)) AS total_gas_used, CAST(transactions_today AS DECIMAL(38,0)) AS transactions_today,
  CAST(market_cap AS DECIMAL(38,0)) AS market_cap, CAST(gas_used_today AS DECIMAL(38,0)) AS gas_used_today, tvl
FROM ranked WHERE rn = 1 AND adj >= {D(Q.EV_START)} AND adj < {D(Q.EV_END)}""",
    )
    act = activity_ctes()
    s["dau"] = with_ctes(*act, DAU, body="SELECT * FROM dau")
    s["wau"] = with_ctes(*act, WAU, body="SELECT * FROM wau")
    s["mau"] = with_ctes(*act, MAU, body="SELECT * FROM mau")
    s["cumulative_users"] = with_ctes(*act, RU, body="SELECT * FROM ru")
    s["new_users"] = with_ctes(*act, NRU, body="SELECT * FROM nru")
    s["user_summary"] = with_ctes(
        *act, DAU, WAU, MAU, RU, NRU,
        body="""SELECT timezone_type, bdate, CAST(coalesce(dau, 0) AS BIGINT) AS dau, CAST(coalesce(wau, 0) AS BIGINT) AS wau,
  CAST(coalesce(mau, 0) AS BIGINT) AS mau, CAST(coalesce(ru, 0) AS BIGINT) AS ru, CAST(coalesce(nru, 0) AS BIGINT) AS nru
FROM dau FULL OUTER JOIN wau USING (timezone_type, bdate)
FULL OUTER JOIN mau USING (timezone_type, bdate)
FULL OUTER JOIN ru USING (timezone_type, bdate)
FULL OUTER JOIN nru USING (timezone_type, bdate)
ORDER BY timezone_type, bdate""",
    )

    # sinks: the final state after two runs
    s["partition_replace"] = f"""WITH r1 AS ({RUN1}), r2 AS ({RUN2})
SELECT * FROM r1 WHERE bdate NOT IN (SELECT DISTINCT bdate FROM r2)
UNION ALL SELECT * FROM r2"""
    s["partitioned_overwrite"] = f"SELECT * FROM ({RUN2})"
    s["unpartitioned_replace"] = f"SELECT * FROM ({RUN2})"
    s["table_by_version"] = s["partitioned_by_version"] = f"SELECT * FROM ({RUN2})"
    s["skip_empty"] = f"SELECT *, CAST(1 AS BIGINT) AS publishes FROM ({RUN1})"
    s["default_slice"] = f"SELECT event_id, ts, {zone_cols('ts')} FROM events WHERE ts >= {TS(Q.SLICE_END)} - INTERVAL 1 DAY AND ts < {TS(Q.SLICE_END)}"
    s["point_scan"] = with_ctes(
        ORDERS_TS, ORDER_ROWS,
        body=f"""SELECT order_id, owner, pair_address, created_at, amount FROM order_rows
WHERE created_at >= {_epoch(Q.ALL_START)} AND created_at < {_epoch(Q.ALL_END)}
  AND (owner = '{Q.POINT_OWNER}' OR (pair_address = '{Q.POINT_PAIR}' AND created_at >= {_epoch(Q.UNTIL_END)}))""",
    )
    s["emptied_days"] = f"""SELECT CAST(ts AS DATE) AS dt_utc, CASE WHEN max(event_id) % 3 = 0 THEN 0 ELSE count(*) END AS events
FROM events WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)} GROUP BY 1"""
    s["append_only"] = f"SELECT * FROM ({RUN1}) UNION ALL SELECT * FROM ({RUN2})"
    s["publish_guarded"] = s["partition_replace"]
    s["daily_from_landed"] = event_daily(Q.SLICE_START, Q.SLICE_END, False)
    s["landing_publish"] = with_ctes(TRANSFERS, body="SELECT * FROM ltransfers")
    s["stream_landing"] = f"SELECT event_id, user_id, event_type, value, ts, {zone_cols('ts')} FROM events"

    # quality
    s["count_reconciliation"] = with_ctes(
        ORDERS_TS, ORDER_ROWS,
        f"""counts AS (
  SELECT 'events' AS service_name, 'events' AS table_name, count(*) AS db_count, count(*) AS s3_count, 0 AS tol
    FROM events WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)}
  UNION ALL
  SELECT 'dex', 'user_orders', count(*), count(CASE WHEN created_at < {_epoch(Q.SNAP_END)} THEN 1 END), 30
    FROM order_rows WHERE created_at < {_epoch(Q.ALL_END)}
  UNION ALL
  SELECT 'dex', 'close_orders', count(*), count(CASE WHEN closed_at < {_epoch(Q.UNTIL_END)} THEN 1 END), 0
    FROM order_rows WHERE o_orderstatus = 'F' AND closed_at < {_epoch(Q.ALL_END)}),
judged AS (SELECT *, db_count = s3_count OR abs(db_count - s3_count) < tol AS passed FROM counts)""",
        body="""SELECT service_name, table_name, db_count, s3_count, s3_count AS catalog_count, passed,
  service_name || '.' || table_name || CASE WHEN passed THEN ' PASS' ELSE ' FAIL' END || ' DB: ' || db_count || ' S3: ' || s3_count
    || ' Catalog: ' || s3_count AS report FROM judged""",
    )
    s["latest_status"] = f"""WITH attempts AS (
  SELECT user_id, CAST(ts AS DATE) AS d, event_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempt
  FROM events WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)})
SELECT 'events' AS schema_name, 'user_' || user_id AS table_name, strftime(d, '%Y-%m-%d 01:00:00') AS batch_ts,
  CAST(attempt AS INTEGER) AS attempt, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS status
FROM attempts QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY d DESC, attempt DESC) = 1
UNION ALL
SELECT 'events', t.table_name, '{Q.BATCH_TS:%Y-%m-%d %H:%M:%S}', t.attempt, t.status
FROM (VALUES ('event_d', 1, 1), ('event_failed_d', 1, 0), ('event_retried_d', 2, 1)) t(table_name, attempt, status)"""
    s["latest_status_compacted"] = s["latest_status"].split("UNION ALL")[0]
    s["order_details_bucketed"] = s["order_details"]
    s["content_reconciliation"] = with_ctes(
        ORDERS_TS, ORDER_ROWS,
        f"src AS (SELECT * FROM order_rows WHERE created_at >= {_epoch(Q.SLICE_ARCHIVED)} AND created_at < {_epoch(Q.ALL_END)})",
        f"""dst AS (SELECT * REPLACE (CASE WHEN closed_at < {_epoch(Q.UNTIL_END)} THEN filled ELSE 0 END AS filled)
  FROM order_rows WHERE created_at >= {_epoch(Q.ALL_START)} AND created_at < {_epoch(Q.UNTIL_END)})""",
        body="""SELECT coalesce(s.order_id, d.order_id) AS order_id, coalesce(s.pair_address, d.pair_address) AS pair_address,
  CASE WHEN d.order_id IS NULL THEN 'lost' WHEN s.order_id IS NULL THEN 'extra' ELSE 'changed' END AS difference
FROM src s FULL JOIN dst d ON s.order_id = d.order_id AND s.pair_address = d.pair_address
WHERE d.order_id IS NULL OR s.order_id IS NULL OR s.filled <> d.filled""",
    )
    s["max_timestamp"] = with_ctes(
        ORDERS_TS, FILLS,
        body=f"""SELECT 'events' AS table_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_ts FROM events
  WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)}
UNION ALL
SELECT 'user_orders', strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM orders_ts WHERE ts < {TS(Q.ALL_END)}
UNION ALL
SELECT 'match_histories', strftime(max({from_epoch('time_utc')}), '%Y-%m-%d %H:%M:%S') FROM fills
  WHERE time_utc >= {_epoch(Q.ALL_START)} AND time_utc < {_epoch(Q.ALL_END)}""",
    )
    s["freshness_equal"] = with_ctes(
        TOKENS, PRICES, MIDNIGHT_PRICE,
        f"l AS (SELECT max(CAST(ts AS DATE)) AS m FROM events WHERE ts >= {TS(Q.EV_START)} AND ts < {TS(Q.EV_END)})",
        "r AS (SELECT max(bdate) AS m FROM mprice)",
        body="SELECT l.m AS left_max, r.m AS right_max, coalesce(l.m = r.m, FALSE) AS is_equal FROM l, r",
    )
    # batches end in the same tables as one direct run
    s["order_details_batched"] = s["order_details"]
    s["order_daily_batched"] = s["order_daily"]
    s["order_daily_delta"] = s["order_daily"]
    s["activity_bitmaps"] = s["user_summary"]
    s["user_summary_batched"] = s["user_summary"]
    s["chain_stats_batched"] = s["chain_stats_backfill"] = s["closest_to_midnight"]

    # API landings: tokens and contracts replaced, stats appended once per load
    s["landing_token"] = f"SELECT * EXCLUDE (event_id) FROM ({s['json_items_explode']})"
    s["landing_contracts"] = f"SELECT * EXCLUDE (s_suppkey) FROM ({s['json_contracts']})"
    s["landing_stats"] = f"""SELECT CAST(l.t AS DATE) AS dt_utc, l.t AS ts_utc, CAST(l.t + INTERVAL 9 HOUR AS DATE) AS dt_kst,
  l.t + INTERVAL 9 HOUR AS ts_kst, total_blocks, total_transactions, gas_prices_fast, tvl
FROM ({s['json_flatten']}), (VALUES ({stamp}), ({stamp} + INTERVAL 24 HOUR)) l(t)"""
    s["json_bad_pages"] = """SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'no items' WHEN 2 THEN 'empty' ELSE 'unparseable' END AS fault
FROM events WHERE event_id % 5 <> 4"""

    # wide numbers: 38 digits times 18 digits by two halves of the value
    digits = f"'{Q.DIGITS}'"
    price = f"substr(CAST(user_id * 31 + 11 AS VARCHAR) || {digits}, 1, CAST(event_id % 17 + 2 AS INTEGER))"
    ten19 = "CAST('10000000000000000000' AS HUGEINT)"
    s["token_scaling"] = f"""WITH raw AS (
  SELECT event_id, CAST(substr(CAST(event_id * 7919 + 13 AS VARCHAR) || {digits}, 1, CAST(event_id % 38 + 1 AS INTEGER)) AS HUGEINT) AS v,
    CAST({price} AS HUGEINT) AS p, event_id % 19 AS k, event_id % 31 AS d FROM events),
halves AS (SELECT *, (v // {ten19}) * p AS hi, (v % {ten19}) * p AS lo FROM raw),
product AS (SELECT *, CAST(hi + lo // {ten19} AS VARCHAR) || lpad(CAST(lo % {ten19} AS VARCHAR), 19, '0') AS vp FROM halves),
exact AS (SELECT event_id, {scaled('CAST(v AS VARCHAR)', 'd')} AS tokens, {scaled('vp', 'd + k')} AS usd FROM product)
SELECT event_id, tokens, usd, tokens IS NULL OR usd IS NULL AS wide, TRUE AS has_usd FROM exact"""
    s["trade_daily_with_open_only"] = s["trade_daily_with_tvl"].split(BODY_MARK)[0] + BODY_MARK + f"""SELECT coalesce(t.timezone_type, v.timezone_type) AS timezone_type,
  coalesce(t.bdate, v.bdate) AS bdate, coalesce(t.pair_name, v.pair_name) AS pair_name, coalesce(t.base_symbol, v.base_symbol) AS base_symbol,
  coalesce(t.quote_symbol, v.quote_symbol) AS quote_symbol, coalesce(tx_cnt, 0) AS tx_cnt, coalesce(avg_price, 0) AS avg_price,
  {", ".join(f"CAST(coalesce({c}, 0) AS {MONEY}) AS {c}" for c in "low_price high_price amount volume volume_usd fee fee_usd tvl_base tvl_base_usd tvl_quote tvl_quote_usd tvl_usd".split())}
FROM trades t FULL OUTER JOIN tvl v ON t.timezone_type = v.timezone_type AND t.bdate = v.bdate
  AND t.pair_name IS NOT DISTINCT FROM v.pair_name AND t.base_symbol IS NOT DISTINCT FROM v.base_symbol
  AND t.quote_symbol IS NOT DISTINCT FROM v.quote_symbol"""
    return s


ORACLE_SQL: dict[str, str] = _sql()
