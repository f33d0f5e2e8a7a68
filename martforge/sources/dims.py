"""The chain dimension, a short literal list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

# --- fixed values: (chain_id, network) -------------------------------------
CHAINS = (
    (612088, "cross_devnet"),
    (612044, "cross_testnet"),
    (612055, "cross_mainnet"),
    (11155111, "eth_testnet"),
    (56, "bnb_mainnet"),
    (97, "bnb_testnet"),
)
# ---------------------------------------------------------------------------

CHAIN_SCHEMA = StructType([StructField("chain_id", LongType(), False), StructField("network", StringType(), False)])


def chain_dim(spark: SparkSession) -> DataFrame:
    """The six known chains with an explicit schema."""
    return spark.createDataFrame(list(CHAINS), CHAIN_SCHEMA)
