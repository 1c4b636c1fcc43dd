"""Key-value cells: build them from records, order them, and route them to regions.

A cell is (row_key, family, qualifier) -> value, all bytes. Cells order byte-wise unsigned by
row, then family, then qualifier; Spark's BINARY comparison is exactly that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from blobtally import schemas
from blobtally.functions.columns import region_bucket
from blobtally.operators.ordered import as_of_join, with_sort_position
from blobtally.sources.cell_store import DirectoryCellStore, put_cells

CELL_ORDER = ["row_key", "family", "qualifier"]
CELLS_DDL = "row_key BINARY, family BINARY, qualifier BINARY, value BINARY"


def _to_binary(df: DataFrame, c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    dtype = df.select(col).schema.fields[0].dataType
    if isinstance(dtype, BinaryType):
        return col
    if isinstance(dtype, StringType):
        return F.encode(col, "UTF-8")
    return F.encode(col.cast("string"), "UTF-8")


def to_cells(df: DataFrame, row_key: str | Column, family: str,
             qualifiers: Mapping[str, str | Column]) -> DataFrame:
    """Unpivot records into cells: one cell per (record, qualifier) whose value is not null.

    Native ``explode(array(struct))``: no Python, and a key-value store has no null cells.
    Values that are not bytes are written as their UTF-8 string form.
    """
    if not qualifiers:
        raise ValueError("at least one qualifier is needed")
    entries = [F.struct(F.lit(q.encode("utf-8")).alias("qualifier"), _to_binary(df, v).alias("value"))
               for q, v in qualifiers.items()]
    return (df.select(_to_binary(df, row_key).alias("row_key"), F.explode(F.array(*entries)).alias("c"))
            .select("row_key", F.lit(family.encode("utf-8")).alias("family"),
                    F.col("c.qualifier").alias("qualifier"), F.col("c.value").alias("value"))
            .filter(F.col("value").isNotNull()))


def flat_map_cells(df: DataFrame,
                   fn: Callable[[dict], Iterable[tuple[bytes, bytes, bytes, bytes]]]) -> DataFrame:
    """Cells from an arbitrary Python function of one record (UDF1, the general form).

    Runs per Arrow batch, whose values reach ``fn`` as Python objects (integers stay integers,
    nulls are None); cells with a null value are dropped. Prefer ``to_cells`` when the mapping is
    a plain unpivot, which stays in the JVM.
    """
    names = CELL_ORDER + ["value"]

    def run(batches):
        for batch in batches:
            out = [cell for rec in batch.to_pylist() for cell in fn(rec) if cell[3] is not None]
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=names)

    return df.mapInArrow(run, CELLS_DDL).filter(F.col("value").isNotNull())


def sort_cells(df: DataFrame, within_partitions: bool = False) -> DataFrame:
    """SRT1: cells in byte-wise (row, family, qualifier) order: globally (range-partitioned
    sort) or only within each partition."""
    if within_partitions:
        return df.sortWithinPartitions(*CELL_ORDER)
    return df.orderBy(*CELL_ORDER)


#: Start keys that may be given as a list: they become literals of one comparison tree in generated code.
MAX_LISTED_KEYS = 4096


def add_region(df: DataFrame, start_keys: Sequence[bytes] | DataFrame, name: str = "region") -> DataFrame:
    """PRT1/J4: region index of each cell (greatest start key <= row key, floor 0; null key: null).

    A sorted list of keys is part of the program: a balanced comparison tree, no shuffle. A table of keys
    (a column ``start_key``, in any order and of any size, null keys ignored) is ranked by a distributed
    sort and joined as of the row key; the region is then the rank of the start key. Without
    start keys everything is in region 0.
    """
    if isinstance(start_keys, DataFrame):
        keys = start_keys.select(F.col("start_key").cast("binary").alias("start_key")).where(F.col("start_key").isNotNull())
        ranked = with_sort_position(keys, ["start_key"], "_rank")
        found = as_of_join(df, ranked, "row_key", "start_key", ["_rank"])
        region = F.when(F.col("row_key").isNotNull(), F.greatest(F.coalesce("_rank", F.lit(1)) - 1, F.lit(0)))
        return found.withColumn(name, region.cast("bigint")).drop("_rank")
    keys = [bytes(k) for k in start_keys]
    if len(keys) > MAX_LISTED_KEYS:
        raise ValueError(f"{len(keys)} start keys in a list; give a table with a column start_key")
    return df.withColumn(name, region_bucket("row_key", keys))


def partition_by_region(df: DataFrame, start_keys: Sequence[bytes] | DataFrame) -> DataFrame:
    """One Spark partition per region, exactly (partition i = region i), sorted inside.

    The original partitioner's contract. A region with a large share of the cells makes one
    large partition; ``bulk_load_cells`` splits such regions.
    """
    n = max(1, start_keys.count() if isinstance(start_keys, DataFrame) else len(start_keys))
    return (add_region(df, start_keys, "_region")
            .repartitionById(n, F.col("_region"))
            .sortWithinPartitions(*CELL_ORDER)
            .drop("_region"))


def bulk_load_cells(df: DataFrame, start_keys: Sequence[bytes] | DataFrame, staging: str,
                    num_files: int | None = None) -> str:
    """SNK9: write cells as sorted files, each inside one region, with a manifest of their key ranges.

    Range partitioning on (region, row, family, qualifier) gives every task a contiguous key
    range, so a hot region is split over several tasks and files instead of one; each file is
    sorted and lies within one region, which is what a bulk load needs. The tasks report the first and last
    key of their files; nothing is published unless the ranges are disjoint. Replaces an earlier load
    of ``staging``; read it back with ``sources.read_cell_store`` and ``read_manifest``.
    """
    with_region = add_region(df, start_keys)
    order = ["region", *CELL_ORDER]
    ranged = (with_region.repartitionByRange(num_files, *order) if num_files
              else with_region.repartitionByRange(*order))
    cells = ranged.sortWithinPartitions(*order).select(F.col("region").cast("bigint").alias("region"), *CELL_ORDER, "value")
    put_cells(cells, DirectoryCellStore(staging, disjoint=True, replace=True))
    return staging


def write_cells_with(df: DataFrame, open_writer: Callable[[], object]) -> int:
    """SNK8 with an external store: every task opens one writer, hands it Arrow batches of
    cells, and closes it; returns the number of cells written.

    ``open_writer()`` runs on the executors and returns an object with ``write(batch)`` (a
    ``pyarrow.RecordBatch`` of row_key, family, qualifier, value) and ``close()``. Batches keep
    the per-row Python work out of Spark; a failed task is retried with a fresh writer, so the
    store's puts should be idempotent (a cell put twice holds the same value).
    """
    import pyarrow as pa

    def run(batches):
        writer = open_writer()
        n = 0
        try:
            for batch in batches:
                if batch.num_rows:
                    writer.write(batch)
                    n += batch.num_rows
        finally:
            writer.close()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    cells = df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.CELLS.fields])
    total = cells.mapInArrow(run, "n BIGINT").agg(F.sum("n")).first()[0]
    return int(total or 0)


def write_cells(df: DataFrame, path: str) -> str:
    """SNK8: persist cells (the replacement for per-record write calls)."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.CELLS.fields]) \
        .write.mode("overwrite").parquet(path)
    return path
