"""Corpus preparation: five stages, each written as Parquet and read again by the next.

quality classifier -> line dedup -> SimHash near-dedup -> mixing sources -> best-fit packing

Every stage function takes (spark, docs, sf_dir) and works on all documents that its
predecessor kept. All but the last return the columns of ``documents``; the last returns the
packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import line_dedup, mixing, packing, quality_gbt, simhash
from martforge.llm.common import crc_mod, read_table, remove, written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more; the labels of the held-out fold are not used."""
    learn = docs.filter(crc_mod(F.col("doc_id"), 4) != 2)
    return quality_gbt.keep_good(docs, quality_gbt.fit(learn, read_table(spark, sf_dir, "labels")), threshold=0.7)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came earlier; documents of nothing else go."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group."""
    return simhash.one_of_each_group(docs, shingle=4, max_bits=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that expected token shares meet the tempered targets."""
    return mixing.sample(docs, TOKENIZER)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset."""
    return packing.pack(docs, TOKENIZER, capacity=1024)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packed),
]

#: Trees, tokenizers and near-duplicate components are not expressible in SQL; the
#: tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; an intermediate table goes when the next one is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs, path = written(stage(spark, docs, sf_dir), f"corpus-stage-{k}")
        if before:
            remove(spark, before)
        before = path
    return docs
