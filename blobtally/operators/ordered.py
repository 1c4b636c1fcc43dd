"""Operators on the global order of a table that is too large for one task: positions and as-of joins.

Both sort once by ranges and write the sorted rows with what their own range can tell; what is
missing is known from one row for each range before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from blobtally.session import materialise


def with_sort_position(df: DataFrame, order: Sequence[str], name: str = "pos") -> DataFrame:
    """Add the 1-based position of every row in the global order ``order``, distributed.

    The range-partitioned sort is written to the shared folder with each row's range and place in it, so
    both passes below see the same ranges; the ranges' counts (one row each) give their
    offsets. No row passes through one task or the driver.
    """
    # monotonically_increasing_id = (partition index << 33) + row index within the partition.
    tagged = materialise(df.orderBy(*order).select("*", F.spark_partition_id().alias("_pid"),
                                                   F.monotonically_increasing_id().alias("_mid")), "positions")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: the only unpartitioned window here, bounded by the partition count.
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + local + 1).cast("bigint"))
            .drop("_pid", "_mid", "_off"))


def _carry(schema: StructType):
    """Arrow function: every row of the left side with the last row of the right side before it.

    One more row for each range holds the range's own last right row.
    """
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        last = None  # the right row seen last, as an array of one
        blank = None
        for batch in batches:
            right = batch.column("_right")
            if last is None:
                last = pa.nulls(1, right.type)
                blank = batch.slice(0, 1)
            n = batch.num_rows
            seen = np.where(right.is_valid().to_numpy(zero_copy_only=False), np.arange(1, n + 1), 0)
            found = pa.concat_arrays([last, right]).take(pa.array(np.maximum.accumulate(seen)))
            last = found.slice(n - 1, 1)
            of_left = batch.column("_left_side")
            out = [batch.column(c) for c in names[:-3]] + [found, pa.array(np.full(n, pid, np.int32)), pa.array(np.zeros(n, bool))]
            yield pa.RecordBatch.from_arrays(out, names=names).filter(of_left)
        if last is not None and last[0].is_valid:
            row = [pa.nulls(1, blank.column(c).type) for c in names[:-3]]
            yield pa.RecordBatch.from_arrays([*row, last, pa.array([pid], pa.int32()), pa.array([True])], names=names)

    return run


def as_of_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, values: Sequence[str],
               forward: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Every row of ``left`` with ``values`` of the ``right`` row with the greatest key <= its own.

    ``forward`` takes the least key >= its own instead. Both sides may be of any size: they are dealt
    together by ranges of the key, a sorted range fills each left row from the right row before it, and
    rows ahead of a range's first right row get the last one of the ranges before, of which there
    is one row for each range. Nothing else is broadcast. Left rows of one key are spread over
    ranges by a hash of the row. A left row without such a key, or with a null key, gets nulls; right
    rows with a null key match nothing. Of right rows with equal keys the one with the greatest
    ``values`` counts (``forward``: the least). ``values`` must not clash with the left columns.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    key_type = left.schema[left_key].dataType
    value_struct = F.struct(*[F.col(v) for v in values])
    right_type = right.select(value_struct.alias("_right")).schema["_right"].dataType
    a = left.select("*", F.col(left_key).alias("_key"), F.lit(True).alias("_left_side"),
                    F.lit(None).cast(right_type).alias("_right"), F.xxhash64(*left.columns).alias("_spread"))
    b = right.where(F.col(right_key).isNotNull()).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields], F.col(right_key).cast(key_type).alias("_key"),
        F.lit(False).alias("_left_side"), value_struct.alias("_right"), F.lit(0).cast("bigint").alias("_spread"))
    order = [F.col("_key").desc() if forward else F.col("_key"), F.col("_left_side"),
             F.col("_right").desc() if forward else F.col("_right"), F.col("_spread")]
    both = a.unionByName(b)
    ranged = both.repartitionByRange(num_partitions, *order) if num_partitions else both.repartitionByRange(*order)
    fields = [StructField(f.name, f.dataType) for f in left.schema.fields] + \
        [StructField("_right", right_type), StructField("_pid", IntegerType()), StructField("_mark", BooleanType())]
    schema = StructType(fields)
    filled = materialise(ranged.sortWithinPartitions(*order).select(*left.columns, "_left_side", "_right")
                         .mapInArrow(_carry(schema), schema), "as-of")
    marks = filled.where("_mark").select("_pid", F.col("_right").alias("_before"))
    ranges = filled.select("_pid").distinct().join(F.broadcast(marks), "_pid", "left")
    # One row per range, so this window and the broadcast are bounded by the partition count.
    before = ranges.select("_pid", F.last("_before", ignorenulls=True).over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    out = filled.where(~F.col("_mark")).join(F.broadcast(before), "_pid", "left")
    match = F.when(F.col(left_key).isNotNull(), F.coalesce("_right", "_before"))
    return out.select(*left.columns, match.alias("_match")).select(*left.columns, *[F.col(f"_match.{v}").alias(v) for v in values])
