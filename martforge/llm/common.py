"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, through Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    A folder of its own is made only where that setting is absent and the master
    is local; a cluster without a shared folder is refused.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not sc.getCheckpointDir():
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="llm-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared)
    return (shared or sc.getCheckpointDir()).rstrip("/")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Checkpoint ``df`` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table of its own in the shared folder, read again, and its path."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` made."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def width(df: DataFrame) -> int:
    """Partitions for an explicit repartitioning: the session's shuffle width."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null text: empty), whatever else the table holds."""
    return df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


#: Sorts before every id; stands for a null one in keys.
NO_ID = -(1 << 63)
#: A document's key: its id, and a hash of its text where the id may not name it alone (else empty).
KEY = ["id", "t"]
#: Bits of the bitmap of ids that occur more than once.
SHARED_BITS = 1 << 17


def shared_ids(docs: DataFrame) -> bytes:
    """A bitmap of fixed size over hashes of the ids that more than one row has."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).filter("id IS NOT NULL").groupBy("id").count().filter("count > 1")
    h = F.xxhash64("id").bitwiseAND(SHARED_BITS - 1)
    # SHARED_BITS / 32768 rows of 4096 bytes at most
    rows = ids.select(F.shiftright(h, 15).alias("b"), h.bitwiseAND(32767).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    out = bytearray(SHARED_BITS // 8)
    for r in rows:
        out[r["b"] * 4096 : (r["b"] + 1) * 4096] = bytes(r["m"])
    return bytes(out)


def keyed(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """KEY, doc_id, text (null: empty) and ``rest``, the carried columns (none: null).

    Keys sort like the ids, null first. Rows have one key if they have one id and one text. Where an id may belong
    to several rows (it is null, or its hash is in the bitmap of shared ids) the key also holds the
    16 bytes of the text's MD5; else these are left out, which saves a third of what is shuffled.
    """
    bitmap, h = F.lit(shared_ids(docs)), F.xxhash64(F.col("doc_id").cast("long")).bitwiseAND(SHARED_BITS - 1)
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(h, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    in_bitmap = F.getbit(byte, h.bitwiseAND(7).cast("int")) == 1
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.when(F.col("doc_id").isNull() | in_bitmap, F.md5(text.cast("binary")))
    rest = F.struct(*carried) if carried else F.lit(None).cast("boolean")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.unhex(digest), F.lit(b"")).alias("t"),
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), rest.alias("rest"),
    )


def blocks(lengths, limit: int):
    """Cut positions so that consecutive items of a batch sum to about ``limit``.

    Yields (from, to) pairs; an item longer than the limit stands alone.
    """
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def sliced(batches, rows: int):
    """Arrow batches of at most ``rows`` rows, so that a worker holds few objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
