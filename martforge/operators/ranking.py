"""Dense positions of rows in a global order, without one task that sees them all."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.session import materialize


def _bases(parts: list[tuple]) -> dict[int, int]:
    """First position of each partition's first group, from (partition, first group, last group, rows of the last)."""
    out, last, carried = {}, None, 0
    for part, first, final, rows in sorted(parts):
        out[part] = carried if first == last else 0
        carried = out[part] + rows if first == final else rows
        last = final
    return out


def positions(df: DataFrame, order: list[str], group: str | None = None, name: str = "at") -> DataFrame:
    """``df`` with each row's position (0, 1, ...) in its group, by ``order`` ascending, nulls first.

    ``group`` must not hold nulls. Rows are dealt by ranges of (group, order), sorted where they are and
    written once; only one row per partition (its first and last group with a count)
    reaches the driver. Rows that tie in ``order`` get neighbouring positions in
    no particular order; where many rows may tie, the last column of ``order`` should tell them
    apart, so that a range can end between them. An empty table stays empty.
    """
    keys = ([group] if group else []) + list(order)
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(width, *keys).sortWithinPartitions(*keys)
    ranged = materialize(ranged.select("*", F.spark_partition_id().alias("_part"), (F.col(group) if group else F.lit("")).alias("_group")))
    sizes = ranged.groupBy("_part", "_group").count()
    ends = sizes.groupBy("_part").agg(F.min("_group").alias("a"), F.max("_group").alias("b"), F.max_by("count", "_group").alias("n"))
    bases = _bases([tuple(r) for r in ends.select("_part", "a", "b", "n").collect()])  # one row per partition

    def counted(batches):
        part, current, at = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index("_group"))
            own = batch.column(batch.schema.get_field_index("_part"))[0].as_py()
            if own != part:
                part, current, at = own, None, bases[own]
            runs = pc.run_end_encode(column)
            out, start = [], 0
            for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if current is not None and value != current:
                    at = 0
                current = value
                out.append(pa.array(range(at, at + end - start), pa.int64()))
                at, start = at + end - start, end
            kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name not in ("_part", "_group")]
            yield pa.RecordBatch.from_arrays([*kept, pa.concat_arrays(out)], names)

    names = [*df.columns, name]
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    return ranged.mapInArrow(counted, schema)
