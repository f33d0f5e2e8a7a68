import datetime as dt
import json
from decimal import Decimal

import pytest

from martforge.sources import payloads
from martforge.sources.dims import CHAINS, chain_dim


def test_token_items(spark):
    pages = [
        json.dumps({"items": [
            {"address": "0xA", "decimals": "18", "holders": 12, "total_supply": "1000", "exchange_rate": "1.005",
             "icon_url": "x", "name": "A", "symbol": "A", "type": "ERC-20", "circulating_market_cap": None},
            {"address": "0xB", "decimals": "abc", "holders": "n/a", "total_supply": "", "type": "ERC-721"},
        ]}),
        json.dumps({"items": []}),
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page int, payload string")
    out = payloads.token_items(df, keep=("page",))
    rows = {r["address"]: r for r in out.collect()}
    assert set(rows) == {"0xA", "0xB"} and "icon_url" not in out.columns
    assert rows["0xA"]["decimals"] == 18 and rows["0xA"]["holders"] == 12
    assert rows["0xA"]["exchange_rate"] == Decimal("1.01") and rows["0xA"]["total_supply"] == Decimal("1000")
    assert rows["0xB"]["decimals"] is None and rows["0xB"]["holders"] is None and rows["0xB"]["total_supply"] is None


@pytest.mark.parametrize("page", [json.dumps({"other": 1}), "not json", '{"items": [{"address": "0xA"}', None])
@pytest.mark.parametrize("read", [payloads.token_items, payloads.contracts])
def test_unusable_pages_fail(spark, page, read):
    good = json.dumps({"items": [{"address": "0xA"}]}) if read is payloads.token_items else json.dumps({"items": [{"address": {"hash": "0xA"}}]})
    df = spark.createDataFrame([(good,), (page,)], "payload string")
    with pytest.raises(Exception, match="payload page is unusable"):
        read(df).collect()
    assert payloads.bad_pages(df).count() == 1


def test_chain_stats(spark):
    obj = {"average_block_time": 1.5, "gas_prices": {"slow": 1, "average": 2.5, "fast": 3}, "coin_image": "i",
           "total_blocks": "123", "total_addresses": 7, "tvl": None, "gas_price_updated_at": "2024-01-01T00:00:00Z"}
    df = spark.createDataFrame([(json.dumps(obj),)], "payload string")
    out = payloads.chain_stats(df, dt.datetime(2024, 1, 1, 20, 0))
    r = out.first()
    assert out.columns[:4] == ["dt_utc", "ts_utc", "dt_kst", "ts_kst"] and len(out.columns) == 23
    assert r["dt_kst"] == dt.date(2024, 1, 2) and r["gas_prices_average"] == 2.5 and r["total_blocks"] == 123
    assert r["tvl"] is None and "coin_image" not in out.columns


def test_contracts_and_chains(spark):
    page = {"items": [{"address": {"hash": "0xAbCd", "name": "C"}, "verified_at": "2024-01-01"},
                      {"address": {"hash": "0xEF"}, "verified_at": None}]}
    df = spark.createDataFrame([(json.dumps(page),)], "payload string")
    out = payloads.contracts(df)
    assert out.columns == ["name", "address", "hash", "verified_at"]
    assert sorted(r["address"] for r in out.collect()) == ["0xabcd", "0xef"]
    chains = chain_dim(spark)
    assert chains.count() == len(CHAINS) == 6
