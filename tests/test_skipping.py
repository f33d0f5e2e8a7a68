"""Z-order layout and bloom filters: the same rows, fewer of them read."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martforge.session import shared_dir
from martforge.sinks import skipping as K


@pytest.fixture(scope="module")
def events(spark):
    return spark.range(60_000).selectExpr(
        "id", "concat('o', lpad(pmod(xxhash64(id), 500), 4, '0')) AS owner", "cast(pmod(xxhash64(id, 1), 300) AS int) AS pair", "date_add(DATE'2024-01-01', cast(id % 60 AS int)) AS d",
        "md5(cast(id AS string)) AS tx",
    )


def test_a_point_scan_reads_fewer_rows_than_by_day(spark, events):
    root = shared_dir(spark, "skip")
    events.repartitionByRange(16, "d").sortWithinPartitions("d").write.option("parquet.block.size", "16384").parquet(f"{root}/by_day")
    K.write_clustered(events, f"{root}/z", ["owner", "pair", "d"], 16, row_group_bytes=16384)
    day, z = spark.read.parquet(f"{root}/by_day"), spark.read.parquet(f"{root}/z")
    assert z.columns == events.columns and z.exceptAll(events).isEmpty() and z.count() == 60_000
    for condition in ("owner = 'o0123'", "pair = 17", "owner = 'o0042' AND pair BETWEEN 10 AND 60"):
        a, b = day.filter(condition), z.filter(condition)
        assert sorted(r["id"] for r in a.collect()) == sorted(r["id"] for r in b.collect())
        assert K.rows_scanned(b) < 0.6 * K.rows_scanned(a), condition
    assert K.rows_scanned(z.filter("d = DATE'2024-01-09'")) < 60_000  # and days are still skipped


def test_bloom_filters_are_written(spark, events):
    root = shared_dir(spark, "skip")
    K.write_clustered(events, f"{root}/b", ["owner", "d"], 2, bloom=["tx"])
    K.write_clustered(events, f"{root}/n", ["owner", "d"], 2)
    table = spark.read.parquet(f"{root}/b")
    missing = "z" * 32  # no such hash; within no row group's filter
    inside = "7" + "f" * 31  # between the least and the largest hash
    assert table.filter(F.col("tx").isin(missing, inside)).count() == 0
    assert K.rows_scanned(table.filter(F.col("tx") == inside)) == 0  # the bloom filter excludes what the range does not
    assert K.rows_scanned(spark.read.parquet(f"{root}/n").filter(F.col("tx") == inside)) == 60_000
    one = table.filter(F.col("tx") == F.md5(F.lit("77").cast("binary"))).collect()
    assert [r["id"] for r in one] == [77]


def test_what_an_open_file_holds_is_bounded(spark, events):
    """Bloom filters of small row groups are small, and more rows make more files, not longer footers."""
    root = shared_dir(spark, "skip")
    K.write_clustered(events, f"{root}/plain", ["owner", "d"], 2, row_group_bytes=16384)
    K.write_clustered(events, f"{root}/bloom", ["owner", "d"], 2, bloom=["tx"], row_group_bytes=16384)
    K.write_clustered(events, f"{root}/many", ["owner", "d"], 2, row_group_bytes=1024)

    def files(name):
        return glob.glob(f"{root}/{name}/*.parquet".removeprefix("file:"))

    assert sum(map(os.path.getsize, files("bloom"))) < 2 * sum(map(os.path.getsize, files("plain")))
    assert len(files("plain")) == 2 and len(files("many")) == 8
    assert spark.read.parquet(f"{root}/many").count() == 60_000


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    bounds = {"a": [1, 2, 3], "b": [1, 2, 3]}
    got = {(r["a"], r["b"]): r["z"] for r in df.select("a", "b", K.interleaved_key(df, bounds, 2).alias("z")).collect()}
    want = {(a, b): sum(((a >> i) & 1) << (2 * i) | ((b >> i) & 1) << (2 * i + 1) for i in range(2)) for a in range(4) for b in range(4)}
    assert got == want
    with pytest.raises(ValueError):
        K.interleaved_key(df, dict.fromkeys("abcdefghijk", [1]), 6)


def test_nulls_and_empty_tables(spark):
    root = shared_dir(spark, "skip")
    df = spark.createDataFrame([(None, 1), ("x", None), (None, None)], "owner string, pair int")
    K.write_clustered(df, f"{root}/nulls", ["owner", "pair"], 2)
    assert sorted(map(str, spark.read.parquet(f"{root}/nulls").collect())) == sorted(map(str, df.collect()))
    K.write_clustered(df.limit(0), f"{root}/none", ["owner", "pair"], 2)
    assert spark.read.schema(df.schema).parquet(f"{root}/none").count() == 0
    assert pq.ParquetDataset(f"{root}/nulls".removeprefix("file:")).schema.names == ["owner", "pair"]
