"""JSON API payloads -> typed tables.

Payload text is landed as a string column (one JSON document per row) and
parsed on the executors with ``from_json`` against a declared schema. All
API fields are first read as strings and then converted with ``try_cast``,
so a malformed number becomes NULL instead of failing the batch or nulling
the whole record.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from martforge.functions.scalars import load_stamp, safe_cast


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# --- fixed values: API field lists ------------------------------------------
# Token list item (ERC-20 and ERC-721 pages), as declared for the landing.
TOKEN_ITEM_FIELDS = (
    "address", "circulating_market_cap", "decimals", "exchange_rate", "holders", "icon_url",
    "name", "symbol", "total_supply", "type", "volume_24h",
)
# Typed columns after landing; icon_url is dropped.
TOKEN_ITEM_CASTS = {
    "circulating_market_cap": "decimal(38,2)",
    "decimals": "int",
    "exchange_rate": "decimal(38,2)",
    "holders": "int",
    "volume_24h": "decimal(38,2)",
    "total_supply": "decimal(38,0)",
}
# Chain statistics object: declared output types, in landing column order.
STATS_FIELDS = (
    ("average_block_time", "double"),
    ("coin_price", "double"),
    ("coin_price_change_percentage", "double"),
    ("gas_price_updated_at", "string"),
    ("gas_prices_slow", "double"),
    ("gas_prices_average", "double"),
    ("gas_prices_fast", "double"),
    ("gas_prices_update_in", "bigint"),
    ("gas_used_today", "bigint"),
    ("market_cap", "bigint"),
    ("network_utilization_percentage", "double"),
    ("secondary_coin_price", "double"),
    ("static_gas_price", "double"),
    ("total_addresses", "int"),
    ("total_blocks", "bigint"),
    ("total_gas_used", "bigint"),
    ("total_transactions", "bigint"),
    ("transactions_today", "bigint"),
    ("tvl", "bigint"),
)
STATS_DROPPED_KEYS = ("coin_image", "secondary_coin_image")
GAS_PRICE_KEYS = ("slow", "average", "fast")
# ---------------------------------------------------------------------------

TOKEN_PAGE_SCHEMA = StructType([StructField("items", ArrayType(_strings(*TOKEN_ITEM_FIELDS)), True)])

_STATS_TOP = [n for n, _ in STATS_FIELDS if not n.startswith("gas_prices_") or n == "gas_prices_update_in"]
STATS_SCHEMA = StructType(
    [StructField(n, StringType(), True) for n in _STATS_TOP]
    + [StructField("gas_prices", _strings(*GAS_PRICE_KEYS), True)]
)

CONTRACT_PAGE_SCHEMA = StructType(
    [
        StructField(
            "items",
            ArrayType(
                StructType(
                    [
                        StructField("address", _strings("hash", "name"), True),
                        StructField("verified_at", StringType(), True),
                    ]
                )
            ),
            True,
        )
    ]
)


UNPARSEABLE, NO_ITEMS, EMPTY = "unparseable", "no items", "empty"


def page_fault(payload: Column | str, items: Column) -> Column:
    """Why a page yields no row: broken JSON, no ``items`` list, or an empty one (else NULL)."""
    text = F.col(payload) if isinstance(payload, str) else payload
    # a page whose items were parsed is well formed; only the others are parsed once more
    broken = F.get_json_object(text, "$").isNull()
    return (
        F.when(text.isNull(), F.lit(UNPARSEABLE))
        .when(items.isNull(), F.when(broken, F.lit(UNPARSEABLE)).otherwise(F.lit(NO_ITEMS)))
        .when(F.size(items) == 0, F.lit(EMPTY))
    )


def _parsed(payloads: DataFrame, payload_col: str, schema: StructType, keep: tuple[str, ...]) -> DataFrame:
    """keep, the page's text and its items. The page is parsed in a generator, whose output the
    optimiser does not write out again wherever a field of it is used."""
    page = F.struct(F.col(payload_col).alias("text"), F.from_json(F.col(payload_col), schema)["items"].alias("items"))
    return payloads.select(*keep, F.explode(F.array(page)).alias("__page")).select(*keep, F.col("__page.text").alias("__text"), F.col("__page.items").alias("__items"))


def bad_pages(payloads: DataFrame, payload_col: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Pages that yield no row, with the reason."""
    pages = _parsed(payloads, payload_col, TOKEN_PAGE_SCHEMA, keep)
    return pages.select(*keep, page_fault("__text", F.col("__items")).alias("fault")).filter("fault IS NOT NULL")


def _items(payloads: DataFrame, payload_col: str, schema: StructType, keep: tuple[str, ...]) -> DataFrame:
    """One row per item; a page that is broken or has no ``items`` fails the job.

    An empty list is a valid page without rows. Nothing is dropped in silence: these
    tables are replaced as a whole, so a lost page would delete its rows.
    """
    pages, items, text = _parsed(payloads, payload_col, schema, keep), F.col("__items"), F.col("__text")
    fault = page_fault(text, items)
    told = F.raise_error(F.concat(F.lit("payload page is unusable ("), fault, F.lit("): "), F.substring(F.coalesce(text, F.lit("NULL")), 1, 80)))
    checked = F.when(fault.isin(UNPARSEABLE, NO_ITEMS), told.cast(schema["items"].dataType)).otherwise(items)
    return pages.select(*keep, checked.alias("__checked")).select(*keep, F.explode("__checked").alias("__i"))


def token_items(payloads: DataFrame, payload_col: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """``{"items": [...]}`` pages -> one typed row per token; unusable pages raise."""
    items = _items(payloads, payload_col, TOKEN_PAGE_SCHEMA, keep).select(*keep, "__i.*")
    out = items.drop("icon_url")
    for name, typ in TOKEN_ITEM_CASTS.items():
        out = out.withColumn(name, safe_cast(name, typ))
    return out


def chain_stats(payloads: DataFrame, load_ts: _dt.datetime, payload_col: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """S11 + F3: one stats object -> one wide row with a load stamp.

    ``gas_prices.{slow,average,fast}`` are flattened, image keys are dropped
    (they are not in the schema), and the output has a fixed column order:
    load stamp in both zones, then the declared fields.
    """
    p = F.from_json(F.col(payload_col), STATS_SCHEMA)
    parsed = payloads.select(*keep, p.alias("__s"))
    cols: list[Column] = []
    for name, typ in STATS_FIELDS:
        if name.startswith("gas_prices_") and name != "gas_prices_update_in":
            src = F.col(f"__s.gas_prices.{name[len('gas_prices_'):]}")
        else:
            src = F.col(f"__s.{name}")
        cols.append((src if typ == "string" else safe_cast(src, typ)).alias(name))
    ts_utc, dt_utc, ts_kst, dt_kst = load_stamp(load_ts)
    return parsed.select(*keep, dt_utc, ts_utc, dt_kst, ts_kst, *cols)


def contracts(payloads: DataFrame, payload_col: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Verified contracts -> ``name, address (lower-cased hash), hash, verified_at``; unusable pages raise."""
    items = _items(payloads, payload_col, CONTRACT_PAGE_SCHEMA, keep)
    return items.select(
        *keep,
        F.col("__i.address.name").alias("name"),
        F.lower(F.col("__i.address.hash")).alias("address"),
        F.col("__i.address.hash").alias("hash"),
        F.col("__i.verified_at").alias("verified_at"),
    )


def json_field(c: Column | str, path: str) -> Column:
    """one value out of a JSON text by path (``$.a.b``)."""
    return F.get_json_object(F.col(c) if isinstance(c, str) else c, path)
