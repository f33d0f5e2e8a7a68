from martforge.operators.enrich import attach_role, remove_matched
from martforge.operators.union import union_by_name


def test_role_playing_joins(spark):
    fact = spark.createDataFrame([(1, "a", "b"), (2, "a", "zz"), (3, None, "b")], "id int, base string, quote string")
    dim = spark.createDataFrame([("a", "Alpha", "A"), ("b", "Beta", "B")], "address string, name string, symbol string")
    out = attach_role(fact, dim, [("base", "address")], {"base_name": "name"}, "base")
    out = attach_role(out, dim, [("quote", "address")], {"quote_name": "name", "quote": "address"}, "quote")
    got = {r["id"]: (r["base_name"], r["quote_name"], r["quote"]) for r in out.collect()}
    assert got == {1: ("Alpha", "Beta", "b"), 2: ("Alpha", None, None), 3: (None, "Beta", "b")}


def test_two_key_join_and_special_names(spark):
    fact = spark.createDataFrame([(1, "x", 5), (2, "x", 6)], "`from` int, address string, chain_id int")
    dim = spark.createDataFrame([("x", 5, "S")], "address string, chain_id int, symbol string")
    out = attach_role(fact, dim, [("address", "address"), ("chain_id", "chain_id")], {"symbol": "symbol"}, "t")
    assert sorted((r["from"], r["symbol"]) for r in out.collect()) == [(1, "S"), (2, None)]


def test_anti_join_and_union(spark):
    live = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "order_id int, pair_address string")
    done = spark.createDataFrame([(1, "p"), (3, "x")], "order_id int, pair_address string")
    still = remove_matched(live, done, ["order_id", "pair_address"])
    assert sorted(r["order_id"] for r in still.collect()) == [2, 3]
    assert union_by_name() is None
    assert union_by_name(live, None) is live
    assert union_by_name(live, done).count() == 5
