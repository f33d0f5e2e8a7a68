"""Incremental landing with Structured Streaming (the daily batch, run as a
stream over newly arrived source files).

The batch operators are slice-based: each run lands ``[start, end)`` and
replaces those partitions. When sources arrive as files, the same landing
transform can run as a stream with ``trigger(availableNow=True)``: every run
picks up only files not yet processed (tracked in the checkpoint), applies
the stateless landing transform (projection, predicate, zone columns), and
appends to a ``dt_utc``-partitioned parquet table through the file sink,
whose metadata log makes the output exactly-once across restarts and lost
executors. No state store is needed: landing is row-wise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pyspark.sql import functions as F

from martforge.sources.scans import DatasetSpec, with_zone_columns


def landing_transform(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Row-wise part of ``land``: projection, zone columns, extra predicate."""
    out = df.select(*spec.select)
    if spec.time_field:
        out = with_zone_columns(out, spec.time_field, spec.time_kind)
    if spec.predicate is not None:
        out = out.filter(F.expr(spec.predicate))
    return out


def land_available(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    spec: DatasetSpec,
    out_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int | None = None,
    file_glob: str | None = None,
) -> StreamingQuery:
    """Land every not-yet-seen source file, then stop (``availableNow``).

    ``source_path`` is a directory; ``file_glob`` selects the files of one
    table when several tables share it.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = landing_transform(reader.parquet(source_path), spec)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
        .partitionBy("dt_utc")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
