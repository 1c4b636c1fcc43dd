"""Compaction planning: pack files into size-bounded splits, plan blob relocation, mark files.

Split packing (CMP1) is a sequential fold: a file joins the open split; once the split's total
reaches ``max_bytes`` it closes (so a split may exceed the cap by its last file). A running sum
that resets is not a window function, so the fold runs in Python, but streaming: files are dealt
by ``pack_group``, a range of file ids of fixed width, sorted by (pack_group, file_id) inside the
partition, and ``mapInPandas`` carries a three-integer state across Arrow batches. No group is
ever held in memory, a group has a bounded number of files, a file that is added changes its own
group alone, and a lost task recomputes the same splits (the order is total).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from blobtally import schemas
from blobtally.session import materialise

ASSIGNMENT_DDL = "file_id BIGINT, pack_group BIGINT, split_id INT, remainSize BIGINT"
DEFAULT_FILES_PER_GROUP = 200_000
# Groups whose open splits are merged by one task.
DEFAULT_GROUPS_PER_TAIL = 1_000


def _fold(max_bytes: int):
    """Arrow-batch fold over rows sorted by (pack_group, file_id)."""
    cap = int(max_bytes)
    long_max = schemas.LONG_MAX

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = None
        split = 0
        current = 0
        for pdf in batches:
            if pdf.empty:
                continue
            groups = pdf["pack_group"].to_numpy()
            remain = pdf["remainSize"].to_numpy()
            split_ids = np.empty(len(pdf), dtype=np.int32)
            for i in range(len(pdf)):
                g = int(groups[i])
                if g != group:
                    group, split, current = g, 0, 0
                split_ids[i] = split
                # Saturating add: an all-archived file (remainSize = LONG_MAX) closes its split
                # instead of wrapping the total negative.
                current = min(current + int(remain[i]), long_max)
                if current >= cap:
                    split += 1
                    current = 0
            yield pd.DataFrame({"file_id": pdf["file_id"].to_numpy(dtype=np.int64),
                                "pack_group": groups.astype(np.int64),
                                "split_id": split_ids,
                                "remainSize": remain.astype(np.int64)})

    return fold


def _pack(files: DataFrame, max_bytes: int) -> DataFrame:
    return (files.repartition("pack_group").sortWithinPartitions("pack_group", "_order", "file_id")
            .select("pack_group", "file_id", "remainSize").mapInPandas(_fold(max_bytes), ASSIGNMENT_DDL))


def _range_of(ids: Column, width: int) -> Column:
    """Floor of ``ids / width`` in exact integer arithmetic."""
    return F.call_function("div", ids - F.pmod(ids, F.lit(width)), F.lit(width))


def plan_splits(status: DataFrame, max_bytes: int, files_per_group: int = DEFAULT_FILES_PER_GROUP,
                include_archived: bool = True, merge_tails: bool = False,
                groups_per_tail: int = DEFAULT_GROUPS_PER_TAIL) -> DataFrame:
    """Assign every file of a file-status table to a split.

    Files go to ``pack_group = floor(file_id / files_per_group)`` and are packed in file_id
    order within their group; neither depends on how many files there are.
    ``include_archived=False`` leaves out all-archived files (remainSize = LONG_MAX).
    ``merge_tails=True`` then re-packs the open last splits of every ``groups_per_tail``
    neighbouring groups, in group order, into one group with a negative number:
    ``-1 - floor(pack_group / groups_per_tail)`` (CMP2). A null remainSize fails the run.

    Returns file_id, pack_group, split_id, remainSize.
    """
    if max_bytes <= 0 or files_per_group <= 0 or groups_per_tail <= 0:
        raise ValueError("max_bytes, files_per_group and groups_per_tail must be positive")
    remain = F.coalesce(F.col("remainSize").cast("bigint"), F.raise_error(F.concat(
        F.lit("no remainSize for file "), F.col("file_id").cast("string"))).cast("bigint"))
    files = status.select(F.col("file_id").cast("bigint"), remain.alias("remainSize"))
    if not include_archived:
        files = files.filter(F.col("remainSize") != F.lit(schemas.ARCHIVED_REMAIN_SIZE))
    files = files.withColumn("pack_group", _range_of(F.col("file_id"), files_per_group)).withColumn("_order", F.lit(0))
    assigned = _pack(files, max_bytes)
    if not merge_tails:
        return assigned
    # The tail merge reads the assignment three times: fold once and write it to the shared folder.
    return _merge_tails(materialise(assigned, "splits"), max_bytes, groups_per_tail)


def _saturating_sum(c: Column) -> Column:
    return F.least(F.sum(c.cast("decimal(38,0)")), F.lit(schemas.LONG_MAX).cast("decimal(38,0)")).cast("bigint")


def _merge_tails(assigned: DataFrame, max_bytes: int, groups_per_tail: int) -> DataFrame:
    sizes = split_summary(assigned)
    last = sizes.groupBy("pack_group").agg(F.max("split_id").alias("split_id"))
    # The open split of a group is its last one, unless that one already reached the cap.
    tails = (sizes.join(last, ["pack_group", "split_id"], "left_semi")
             .filter(F.col("size") < max_bytes)
             .select("pack_group", "split_id"))
    tail_files = assigned.join(tails, ["pack_group", "split_id"], "left_semi")
    kept = assigned.join(tails, ["pack_group", "split_id"], "left_anti")
    merged = tail_files.select("file_id", "remainSize", F.col("pack_group").alias("_order"),
                               (-1 - _range_of(F.col("pack_group"), groups_per_tail)).alias("pack_group"))
    return kept.unionByName(_pack(merged, max_bytes))


def split_summary(assigned: DataFrame) -> DataFrame:
    """CMP5: per split, its size (saturating at LONG_MAX) and file count."""
    return assigned.groupBy("pack_group", "split_id").agg(
        _saturating_sum(F.col("remainSize")).alias("size"),
        F.count(F.lit(1)).alias("n_files"))


DEFAULT_CHUNK_BYTES = 64 * 1024 * 1024


def plan_relocation(assigned: DataFrame, meta: DataFrame,
                    key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER,
                    chunk_bytes: int = DEFAULT_CHUNK_BYTES) -> DataFrame:
    """CMP3, re-aimed as a plan: where each live blob lands when its split is rewritten.

    Blobs (meta rows de-duplicated on file and blob) are laid back to back in each split, in
    (file_id, start, blob_id) order. Offsets come in two levels so that no window partition
    grows with a hot file: each file's byte range is cut into chunks of ``chunk_bytes``
    (``start div chunk_bytes``); chunk totals give every chunk's offset in its split (one row
    per chunk), and a window inside each (file, chunk) gives each blob's offset in its chunk.
    De-duplication is a partial aggregation, so a blob referenced by millions of objects
    collapses map-side before the shuffle.
    Returns pack_group, split_id, file_id, blob_id, start, length, new_start.
    """
    if chunk_bytes <= 0:
        raise ValueError("chunk_bytes must be positive")
    key = F.col("meatRowKey")
    sep = F.instr(key, key_delimiter)
    blobs = (meta.select(F.substring_index(key, key_delimiter, 1).cast("bigint").alias("file_id"),
                         F.substring(key, sep + F.lit(len(key_delimiter)), F.lit(1 << 30)).alias("blob_id"),
                         "start", "length")
             # A blob without a start sorts first (as NULLS FIRST would) in chunk -1.
             .withColumn("chunk", F.coalesce(F.call_function("div", F.col("start"), F.lit(chunk_bytes)),
                                             F.lit(-1).cast("bigint")))
             .select("file_id", "chunk", "blob_id", "start", "length")
             .distinct())
    before = Window.unboundedPreceding
    in_chunk = blobs.withColumn("in_chunk", F.coalesce(F.sum("length").over(
        Window.partitionBy("file_id", "chunk").orderBy("start", "blob_id").rowsBetween(before, -1)), F.lit(0)))
    chunks = (blobs.groupBy("file_id", "chunk")
              .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("chunk_bytes"))
              .join(assigned.select("file_id", "pack_group", "split_id"), "file_id"))
    chunk_offsets = chunks.select(
        "file_id", "chunk", "pack_group", "split_id",
        F.coalesce(F.sum("chunk_bytes").over(Window.partitionBy("pack_group", "split_id")
                                             .orderBy("file_id", "chunk").rowsBetween(before, -1)),
                   F.lit(0)).alias("chunk_offset"))
    return (in_chunk.join(chunk_offsets, ["file_id", "chunk"])
            .select("pack_group", "split_id", "file_id", "blob_id", "start", "length",
                    (F.col("chunk_offset") + F.col("in_chunk")).cast("bigint").alias("new_start")))


def apply_to_splits(plan: DataFrame, hook: Callable[[dict, Iterator[pa.RecordBatch]], dict], result_ddl: str,
                    split_columns: Sequence[str] = ("pack_group", "split_id")) -> DataFrame:
    """UDF4: one result of a user function for each split of a relocation plan.

    ``hook(split, batches)`` gets the split's key columns and its blobs in the order of the new file
    (new_start; blobs of no length by file and id), as Arrow batches that are cut at the split's end: it
    streams, so a split may be larger than memory. It returns a dict with the columns of
    ``result_ddl``, and need not read its batches to the end. The result is the key columns and these. A
    split is one task's work, as its blobs go to one new file; a split is retried as a whole.
    """
    keys = list(split_columns)
    schema = StructType([f for f in plan.schema.fields if f.name in keys] + StructType.fromDDL(result_ddl).fields)
    order = [*keys, "new_start", "file_id", "start", "blob_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cuts() -> Iterator[tuple[tuple, pa.RecordBatch]]:
            for batch in batches:
                values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
                edge = np.zeros(max(batch.num_rows - 1, 0), bool)
                for v in values:
                    edge |= v[1:] != v[:-1]
                at = [0, *(np.flatnonzero(edge) + 1).tolist(), batch.num_rows]
                for a, b in zip(at, at[1:]):
                    if a < b:
                        yield tuple(batch.column(k)[a].as_py() for k in keys), batch.slice(a, b - a)

        done = []
        for key, group in groupby(cuts(), key=itemgetter(0)):
            split = dict(zip(keys, key))
            blobs = (batch for _, batch in group)
            done.append({**split, **hook(split, blobs)})
            for _ in blobs:
                pass
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    arrow = to_arrow_schema(schema)
    return plan.repartition(*keys).sortWithinPartitions(*order).mapInArrow(run, schema)


def mark_deleted(status: DataFrame, predicate: Column | None = None,
                 min_empty_percent: int | None = None) -> DataFrame:
    """CMP4, re-aimed as marking: set ``deleted`` where ``predicate`` (or emptyPercent >=
    ``min_empty_percent``) holds; files already marked stay marked. Removes nothing."""
    if predicate is None:
        if min_empty_percent is None:
            raise ValueError("give a predicate or min_empty_percent")
        predicate = F.col("emptyPercent") >= F.lit(min_empty_percent)
    return status.select("file_id", "emptyPercent", "remainSize", "path",
                         (F.coalesce(F.col("deleted"), F.lit(False))
                          | F.coalesce(predicate, F.lit(False))).alias("deleted"))
