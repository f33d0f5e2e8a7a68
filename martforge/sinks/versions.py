"""Whole-table publishes by location switch (K2 / K3 without a moment without a table).

Each publish writes a folder of its own (``<path>/v00000012-<tag>``); readers get it by one change in the
catalog when it is complete. Nothing is renamed or copied, so the cost on an object store is the
write itself, and a reader that has planned on the old version goes on reading its files, which stay
until ``retire`` removes them.

* A table without partitions is an external table whose location is altered.
* A partitioned one has the locations of its partitions in the catalog, which cannot be altered all at
  once. Each version is therefore registered as a table of its own, with its partitions, and the
  published name is a view of the current one, replaced in one step.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from martforge.sinks.writes import cluster_for_write, file_system, folder_names

_VERSION = re.compile(r"v(\d{8})-[0-9a-f]+")


def versions(spark: SparkSession, path: str) -> list[str]:
    """Version folders of a table, oldest first (complete or not)."""
    return sorted(n for n in folder_names(spark, path) if _VERSION.fullmatch(n))


def _table_of(name: str, version: str) -> str:
    return f"{name}__{version.replace('-', '_')}"


def current_version(spark: SparkSession, name: str, path: str) -> str | None:
    """The version that readers of ``name`` get; None before the first publish."""
    if not spark.catalog.tableExists(name):
        return None
    kind = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    found = _VERSION.search((kind.get("Location") or "").rstrip("/").rsplit("/", 1)[-1])
    if found is None:
        found = re.search(r"__(v\d{8}_[0-9a-f]+)", kind.get("View Text") or "")
        if found is None:
            raise ValueError(f"{name} is not a versioned table")
        return found[1].replace("_", "-")
    return found[0]


def publish_version(df: DataFrame, name: str, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet", keep: int = 2) -> str:
    """Write ``df`` as a new version of ``name`` and switch readers to it; returns the version's folder.

    A write that fails leaves the old version in place and its own folder is removed. The
    newest ``keep`` versions up to the current one stay for readers that have begun; 1 keeps only the current one.
    """
    spark = df.sparkSession
    if keep < 1:
        raise ValueError("the current version has to stay")
    before = current_version(spark, name, path)
    number = max((int(_VERSION.fullmatch(v)[1]) for v in versions(spark, path)), default=0) + 1
    version = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path.rstrip('/')}/{version}"
    writer = cluster_for_write(df, partition_cols).write.format(fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    try:
        writer.save(folder)
    except Exception:
        fs, where = file_system(spark, folder)
        fs.delete(where, True)
        raise
    if partition_cols:
        own = _table_of(name, version)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)  # also where no row was written
        by = ", ".join(f"`{c}`" for c in partition_cols)
        spark.sql(f"CREATE TABLE {own} ({ddl}) USING {fmt} PARTITIONED BY ({by}) LOCATION '{folder}'")
        spark.sql(f"MSCK REPAIR TABLE {own}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {own}")
    elif before is None:
        spark.catalog.createTable(name, path=folder, source=fmt)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    retire(spark, name, path, keep)
    return folder


def retire(spark: SparkSession, name: str, path: str, keep: int = 2) -> list[str]:
    """Remove versions older than the newest ``keep`` up to the current one; returns them.

    Folders newer than the current version belong to a publish under way and stay.
    """
    now = current_version(spark, name, path)
    if now is None:
        return []
    past = [v for v in versions(spark, path) if v <= now]
    gone = past[: max(0, len(past) - keep)]
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_table_of(name, version)}")
        fs, where = file_system(spark, f"{path.rstrip('/')}/{version}")
        fs.delete(where, True)
    return gone
