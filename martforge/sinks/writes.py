"""Sinks K1-K10: partition-replacing writes, appends, ledger and publish.

Partition replacement uses Spark's dynamic partition overwrite: exactly the
partitions present in the new data are replaced, others are untouched. No
driver-side listing or deletion and no ``distinct().collect()`` of partition
values is needed; new files are staged and moved in at job commit.
"""

from __future__ import annotations

import datetime as _dt
import os
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from martforge.operators.timeslice import DateLike, as_date
from martforge.session import materialize


def table_path(root: str, schema: str, layer: str, table: str) -> str:
    """K6: ``{root}/results/{schema}/{layer}/{layer}_{table}``; the table name is
    cut at the first space (a join text names its first table)."""
    return f"{root.rstrip('/')}/results/{schema}/{layer}/{layer}_{table.split(' ')[0]}"


def default_partitions(table: str, partition_cols: Sequence[str] | None) -> list[str]:
    """K5: ``None`` -> ``bdate`` for daily (``_d``) tables else ``dt_utc``; ``[]`` -> none."""
    if partition_cols is None:
        return ["bdate"] if table.split(" ")[0].endswith("_d") else ["dt_utc"]
    return list(partition_cols)


def cluster_for_write(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Group rows of the same output partition into few tasks before writing.

    Without it every task writes one file into every partition value it
    holds (tasks x days small files). ``REBALANCE`` shuffles by the partition
    columns and lets AQE coalesce small groups to the advisory size and split
    a hot partition value over several tasks, so one huge day is not written
    by one task.
    """
    if not partition_cols:
        return df
    return df.hint("rebalance", *partition_cols)


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet") -> None:
    """K1: replace exactly the partitions present in ``df`` (dynamic overwrite).

    With no partition columns this is a full replace (K2). A partition that
    has no rows in ``df`` is left as it was (see ``publish`` for days that a slice empties).
    """
    if not partition_cols:
        replace_table(df, path, (), fmt)
        return
    writer = cluster_for_write(df, partition_cols).write.format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).save(path)


def file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by one listing; none if it is not there."""
    fs, where = file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def files_of_days(spark: SparkSession, path: str, column: str, first: DateLike, end: DateLike) -> dict[str, frozenset]:
    """Data files of each day partition in ``[first, end)``: one listing, and one for each day that is there."""
    lo, hi = (f"{column}={as_date(d).isoformat()}" for d in (first, end))
    days = [n for n in folder_names(spark, path) if lo <= n < hi and re.fullmatch(r"\d{4}-\d\d-\d\d", n.split("=", 1)[1])]
    return {n.split("=", 1)[1]: frozenset(f for f in folder_names(spark, f"{path}/{n}") if not f.startswith(("_", "."))) for n in days}


def replace_days(
    df: DataFrame, path: str, column: str, first: DateLike, end: DateLike, fmt: str = "parquet", catalog_name: str | None = None
) -> list[str]:
    """K1 for a slice: replace the days ``[first, end)`` of a table, also those that ``df`` has no rows of.

    Days that the table held and that got no new file are emptied: dropped from the catalog, then from the
    files. Returns them. ``df`` is computed once; the days are told by the names of their files
    (a write never reuses one). A run that dies in between leaves stale days, never a
    missing one, and the next run finds them again.
    """
    spark = df.sparkSession
    before = files_of_days(spark, path, column, first, end)
    replace_partitions(df, path, [column], fmt)
    after = files_of_days(spark, path, column, first, end) if before else {}
    emptied = sorted(d for d, files in before.items() if files and after.get(d) == files)
    if emptied and catalog_name and spark.catalog.tableExists(catalog_name):
        spark.sql(f"ALTER TABLE {catalog_name} DROP IF EXISTS " + ", ".join(f"PARTITION ({column}='{d}')" for d in emptied))
    for day in emptied:
        fs, where = file_system(spark, f"{path}/{column}={day}")
        fs.delete(where, True)
    return emptied


def recover_table(spark: SparkSession, path: str) -> bool:
    """Put back the old table where a replace died between its two renames; True if it did."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    fs, here = file_system(spark, path)
    if fs.exists(here):
        return False
    old = sorted(n for n in folder_names(spark, parent) if n.startswith(f"{name}__old_"))
    return bool(old) and fs.rename(file_system(spark, f"{parent}/{old[-1]}")[1], here)


def replace_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """K2 / K3: replace the whole table, partitioned or not.

    The new table is written beside the old one and takes its place when it is
    complete (Spark's own overwrite deletes first, so a failing job would leave no table). For tables that
    are read by path; between its two renames there is none, and a run that dies there is mended
    by ``recover_table`` in the next. ``sinks.versions`` publishes without that moment.
    """
    recover_table(df.sparkSession, path)
    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    fresh, stale = f"{path}__new_{tag}", f"{path}__old_{tag}"
    fs, new = file_system(spark, fresh)
    _, here = file_system(spark, path)
    _, old = file_system(spark, stale)
    writer = cluster_for_write(df, partition_cols).write.format(fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    try:
        writer.save(fresh)
    except Exception:
        fs.delete(new, True)
        raise
    if fs.exists(here):
        fs.rename(here, old)
    if not fs.rename(new, here):
        fs.rename(old, here)
        raise OSError(f"could not move {fresh} to {path}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def append_rows(df: DataFrame, path: str, table: str, partition_cols: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """K4: pure append, no deletion; daily (``_d``) tables always go by ``bdate``."""
    cols = default_partitions(table, partition_cols)
    if cols and table.endswith("_d"):
        cols = ["bdate"]
    writer = cluster_for_write(df, cols).write.format(fmt).mode("append")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system Spark reads."""
    fs, where = file_system(spark, path)
    return fs.exists(where)


def register_table(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", days: tuple[str, DateLike, DateLike] | None = None
) -> None:
    """K7: external catalog table over ``path`` (created if missing) with its partitions.

    ``days`` = (column, first, end) adds only the day partitions of that slice that
    exist, told by one listing of the table's folder. Without it (a table replaced
    as a whole) the catalog is synchronised with all partitions.
    """
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
    if not any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.refreshTable(name)
        return
    if days is None:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    else:
        column, first, end = days
        lo, hi = (f"{column}={as_date(d).isoformat()}" for d in (first, end))
        there = [f"PARTITION ({column}='{n.split('=', 1)[1]}')" for n in sorted(folder_names(spark, path)) if lo <= n < hi]
        if there:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(there)}")
    spark.catalog.refreshTable(name)


LEDGER_SCHEMA = StructType(
    [
        StructField("schema_name", StringType(), False),
        StructField("table_name", StringType(), False),
        StructField("batch_ts", StringType(), False),
        StructField("start_date", StringType(), True),
        StructField("end_date", StringType(), True),
        StructField("status", IntegerType(), False),
        StructField("attempt", IntegerType(), False),
        StructField("emptied_days", StringType(), True),
        StructField("batch_bdate", StringType(), False),
    ]
)


@dataclass(frozen=True)
class JobInfo:
    """Run parameters of one published table (no wall clock inside)."""

    schema_name: str
    data_layer: str
    table_name: str
    start_date: DateLike
    end_date: DateLike
    batch_ts: _dt.datetime


def _stamp(job: JobInfo) -> str:
    return job.batch_ts.strftime("%Y-%m-%d %H:%M:%S")


def next_attempt(spark: SparkSession, ledger_path: str, job: JobInfo) -> int:
    """1, or one more than the attempts of this table and batch so far (reads one ledger day)."""
    ts = _stamp(job)
    if not path_exists(spark, f"{ledger_path}/batch_bdate={ts[:10]}"):
        return 1
    mine = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).filter(
        (F.col("batch_bdate") == ts[:10])
        & (F.col("batch_ts") == ts)
        & (F.col("schema_name") == job.schema_name)
        & (F.col("table_name") == job.table_name.split(" ")[0])
    )
    return (mine.agg(F.max("attempt")).first()[0] or 0) + 1


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of several callers at once only one gets True."""
    fs, where = file_system(spark, path)
    fs.mkdirs(where.getParent())
    if fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
        try:
            os.close(os.open(where.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(where, False).close()
    except Py4JJavaError as exc:
        if "AlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    return True


def claim_attempt(spark: SparkSession, ledger_path: str, job: JobInfo) -> int:
    """An attempt number of this table and batch that no other run gets, also of two that start at once.

    The number is claimed by creating an empty file of its name in ``_claims`` beside the ledger's days (readers
    skip the folder), which only one run can do; a number is never used again, so attempts of runs that died
    without a ledger row leave gaps.
    """
    ts = _stamp(job)
    table = f"{job.schema_name}.{job.table_name.split(' ')[0]}"
    folder = f"{ledger_path.rstrip('/')}/_claims/{ts[:10]}/{table}/{ts[11:].replace(':', '')}"
    attempt = next_attempt(spark, ledger_path, job)
    while not create_new(spark, f"{folder}/{attempt}"):
        attempt += 1
    return attempt


def compact_ledger(spark: SparkSession, ledger_path: str, before: DateLike, files: int = 1) -> list[str]:
    """Merge the small files of ledger days before ``before`` into one each; returns the days rewritten.

    Every publish appends a file. Days that no run appends to any more are read once and replaced partition
    by partition; a reader sees a day's old files or its new one. Claims of these days go as well.
    """
    limit = as_date(before).isoformat()
    days = [n.split("=", 1)[1] for n in folder_names(spark, ledger_path) if n.startswith("batch_bdate=") and n.split("=", 1)[1] < limit]
    many = [d for d in sorted(days) if sum(not n.startswith(("_", ".")) for n in folder_names(spark, f"{ledger_path}/batch_bdate={d}")) > files]
    if many:
        rows = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).filter(F.col("batch_bdate").isin(many))
        rows = materialize(rows)  # the partitions that are read are the ones replaced
        writer = rows.repartition(min(len(many), 64), "batch_bdate").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_bdate").parquet(ledger_path)
    for day in folder_names(spark, f"{ledger_path}/_claims"):
        if day < limit:
            fs, where = file_system(spark, f"{ledger_path}/_claims/{day}")
            fs.delete(where, True)
    return many


def ledger_rows(jobs: Sequence[tuple[JobInfo, int, int, Sequence[str]]]) -> list[tuple]:
    """Ledger rows of (job, status, attempt, emptied days)."""
    return [
        (
            job.schema_name, job.table_name.split(" ")[0], _stamp(job), as_date(job.start_date).isoformat(), as_date(job.end_date).isoformat(),
            int(status), int(attempt), ",".join(emptied) or None, _stamp(job)[:10],
        )
        for job, status, attempt, emptied in jobs
    ]


def ledger_append(spark: SparkSession, ledger_path: str, job: JobInfo, status: int, attempt: int = 1, emptied: Sequence[str] = ()) -> None:
    """K8: one status row (1 ok, 0 failed) appended, partitioned by ``batch_bdate``.

    ``emptied``: days that the run left without rows, named in ``emptied_days`` (null: none).
    """
    ledger_append_all(spark, ledger_path, [(job, status, attempt, emptied)])


def ledger_append_all(spark: SparkSession, ledger_path: str, jobs: Sequence[tuple[JobInfo, int, int, Sequence[str]]]) -> None:
    """K8 for many batches at once: one row of each, in one write."""
    rows = spark.createDataFrame(ledger_rows(jobs), LEDGER_SCHEMA).coalesce(1)
    rows.write.mode("append").partitionBy("batch_bdate").parquet(ledger_path)


PARTITIONS, TABLE, APPEND = "partitions", "table", "append"


def publish(
    spark: SparkSession,
    df: DataFrame,
    job: JobInfo,
    root: str,
    ledger_path: str,
    partition_cols: Sequence[str] | None = None,
    catalog_name: str | None = None,
    skip_empty: bool = False,
    how: str = PARTITIONS,
    fmt: str = "parquet",
    drop_empty: bool = False,
) -> str:
    """K9: write -> register (K7) -> ledger 1 (K8); on any error ledger 0, re-raise.

    Success is recorded last, so a batch whose registration failed never reads as done.
    ``how``: replace the partitions in ``df`` (K1), the whole table (K2/K3) or append
    (K4). ``drop_empty``: the slice's days are replaced altogether, so days of it without rows any more
    are removed too and named in the ledger (for tables with one day column). ``skip_empty`` (K10) checks ``isEmpty()`` first - one cheap job; a dynamic
    overwrite of zero rows would leave the table untouched anyway.
    """
    path = table_path(root, job.schema_name, job.data_layer, job.table_name)
    if skip_empty and df.isEmpty():
        return path
    cols = default_partitions(job.table_name, partition_cols)
    attempt = claim_attempt(spark, ledger_path, job)
    emptied: list[str] = []
    try:
        if how == PARTITIONS and drop_empty and len(cols) == 1:
            emptied = replace_days(df, path, cols[0], job.start_date, job.end_date, fmt, catalog_name)
        elif how == TABLE:
            replace_table(df, path, cols, fmt)
        elif how == APPEND:
            append_rows(df, path, job.table_name, cols, fmt)
        else:
            replace_partitions(df, path, cols, fmt)
        if catalog_name:
            days = None
            if how != TABLE and len(cols) == 1:  # a zone's day may start on the UTC day before the slice
                days = (cols[0], as_date(job.start_date) - _dt.timedelta(days=1), as_date(job.end_date) + _dt.timedelta(days=1))
            register_table(spark, catalog_name, path, fmt, days)
    except Exception:
        ledger_append(spark, ledger_path, job, 0, attempt)
        raise
    ledger_append(spark, ledger_path, job, 1, attempt, emptied)
    return path
