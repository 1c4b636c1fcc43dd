"""One sequential split fold over a whole table, computed in parallel (AGG9, UDF3).

With P(i) the bytes before file i in file order, the split that starts at i ends before the first
file j with P(j) >= P(i) + max_bytes: every file has a next split start, and the splits are the chain
of next starts from the first file. The chain is found without walking it:

1. Files are dealt by ranges of ids (blocks), and neighbouring blocks go to one task as a *run*. A task
   reads its run in order. In what it has read the starts are chained by doubling, and starts next
   to each other whose chains leave it alike form one *entry class*; files that follow carry the
   chains on, and classes whose chains meet become one. Only starts that a split from before the run can
   reach are kept. A run with very many classes is cut, so a task holds a bounded number of them.
2. A class is left at a known place of the whole order, and the class that holds the first file
   there is its successor (an as-of join over all classes).
3. Doubling over the successors marks the classes on the chain from the first file, each with the
   place where it is entered and the splits before it.
4. Every run then knows where the split that is open at its first file ends, and numbers its
   files in one pass.

The result does not depend on the blocks or the runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blobtally.operators.ordered import as_of_join
from blobtally.session import materialise

DEFAULT_FILES_PER_BLOCK = 200_000
#: Files chained at once, and classes and bytes at which a run is cut; places in a run stay below 2^63.
_PIECE_FILES, _RUN_CLASSES, _RUN_BYTES = 65_536, 200_000, 1 << 61
_WIDE = "decimal(38,0)"


def _block(ids: Column, width: int) -> Column:
    return F.call_function("div", ids - F.pmod(ids, F.lit(width)), F.lit(width))


def entry_classes(sizes: np.ndarray, max_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of a block's files as split starts: (last member, bytes before the start that leaves the
    block plus ``max_bytes``, splits started in the block), from its first file on."""
    before = np.cumsum(sizes) - sizes
    n = len(sizes)
    step = np.searchsorted(before, before + max_bytes, side="left")
    here = np.arange(n)
    last = np.where(step < n, np.minimum(step, n - 1), here)
    count = np.where(step < n, 1, 0)
    while True:  # twice as far along the chain each time
        further = last[last]
        if np.array_equal(further, last):
            break
        count, last = count + count[last], further
    ends = np.flatnonzero(np.append((last[1:] != last[:-1]) | (count[1:] != count[:-1]), True))
    return ends, before[last[ends]] + max_bytes, count[ends] + 1


class RunClasses:
    """Entry classes of a run of files that is read piece by piece, in order. Places are bytes from the run's first file.

    A split that began before the run ends at most ``max_bytes`` after the run's first file, so the starts that are entered from
    outside are the files up to the first one there; the others only carry chains on.
    """

    def __init__(self, max_bytes: int, most_classes: int = _RUN_CLASSES):
        self.max_bytes, self.most_classes, self.bytes, self.last = max_bytes, most_classes, 0, 0
        self.upto = self.leaves = self.starts = np.zeros(0, np.int64)

    def extend(self, sizes: np.ndarray) -> None:
        ends, out, count = entry_classes(sizes, self.max_bytes)
        before = self.bytes + np.cumsum(sizes) - sizes
        upto, out = before[ends], self.bytes + out
        self.last, self.bytes = int(before[-1]), self.bytes + int(sizes.sum())
        here = self.leaves <= self.last
        at = np.minimum(np.searchsorted(upto, self.leaves, side="left"), len(upto) - 1)
        starts, leaves = self.starts + np.where(here, count[at], 0), np.where(here, out[at], self.leaves)
        reached = 0
        if not len(self.upto) or self.upto[-1] < self.max_bytes:
            reached = int(np.searchsorted(upto, self.max_bytes, side="left")) + 1
        upto, leaves, starts = (np.append(x, y[:reached]) for x, y in ((self.upto, upto), (leaves, out), (starts, count)))
        kept = np.append((leaves[1:] != leaves[:-1]) | (starts[1:] != starts[:-1]), True)
        self.upto, self.leaves, self.starts = upto[kept], leaves[kept], starts[kept]

    def full(self) -> bool:
        return len(self.upto) >= self.most_classes or self.bytes >= _RUN_BYTES


def number_files(sizes: np.ndarray, before: int, start: int | None, split: int, max_bytes: int) -> tuple[np.ndarray, int | None]:
    """Split of each file, and where the next split starts: ``before`` bytes lie before the files, in split ``split``, and
    the next one starts at the first file with ``start`` bytes before it (None: there is no further one)."""
    at = before + np.cumsum(sizes) - sizes
    opens = np.zeros(len(sizes), np.int64)
    if start is not None:
        step = np.searchsorted(at, at + max_bytes, side="left").tolist()
        i = int(np.searchsorted(at, start, side="left"))
        while i < len(step):
            opens[i], start, i = 1, int(at[i]) + max_bytes, step[i]
    return split + np.cumsum(opens), start


def plan_table_splits(status: DataFrame, max_bytes: int, files_per_block: int = DEFAULT_FILES_PER_BLOCK,
                      include_archived: bool = True) -> DataFrame:
    """Assign the files of a file-status table to splits in file_id order, over the whole table.

    A file joins the open split, which closes once it holds ``max_bytes`` or more; the next file starts
    the next split. Equal to that fold over all files for every ``files_per_block`` (a width
    of file ids). ``include_archived=False`` leaves out all-archived files. A null or
    negative remainSize fails the run; an empty table gives an empty result. Returns file_id,
    split_id (bigint, from 0), remainSize.
    """
    from blobtally import schemas

    if max_bytes <= 0 or files_per_block <= 0:
        raise ValueError("max_bytes and files_per_block must be positive")
    if max_bytes * files_per_block >= 1 << 62:
        raise ValueError("max_bytes * files_per_block must be below 2^62")
    size = F.col("remainSize").cast("bigint")
    checked = F.when(size >= 0, size).otherwise(F.raise_error(F.concat(
        F.lit("no remainSize, or a negative one, for file "), F.col("file_id").cast("string"))).cast("bigint"))
    files = status.select(F.col("file_id").cast("bigint").alias("file_id"), checked.alias("remainSize"))
    if not include_archived:
        files = files.filter(F.col("remainSize") != F.lit(schemas.ARCHIVED_REMAIN_SIZE))
    # A file that fills a split closes it whatever more it holds, so sizes above the cap count as the cap.
    files = files.select("file_id", "remainSize", F.least("remainSize", F.lit(max_bytes)).alias("size"),
                         _block(F.col("file_id"), files_per_block).alias("block"))
    files = materialise(files, "files")

    n_blocks = files.select("block").distinct().count()
    if not n_blocks:
        return files.select("file_id", F.lit(0).cast("bigint").alias("split_id"), "remainSize")
    # Runs of whole blocks: enough of them for the tasks, few against the blocks.
    n_runs = min(n_blocks, max(math.isqrt(n_blocks), int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    piece, most_classes = max(1, min(_PIECE_FILES, _RUN_BYTES // max_bytes)), _RUN_CLASSES

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every file with its run, and the classes of each run, in one table."""
        run, now = TaskContext.get().partitionId() << 32, RunClasses(max_bytes, most_classes)
        numbers = ["class", "upto", "leaves", "starts", "last", "total"]
        names = ["run", "file_id", "remainSize", "size", *numbers]

        def classes() -> pa.RecordBatch:
            n = len(now.upto)
            held = [np.arange(n), now.upto, now.leaves, now.starts, np.full(n, now.last), np.full(n, now.bytes)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, run)), *[pa.nulls(n, pa.int64())] * 3, *map(pa.array, held)], names=names)

        for batch in batches:
            for a in range(0, batch.num_rows, piece):
                if now.full():
                    yield classes()
                    run, now = run + 1, RunClasses(max_bytes, most_classes)
                part = batch.slice(a, piece)
                now.extend(part.column("size").to_numpy())
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, run)), *part.columns, *[none] * len(numbers)], names=names)
        if len(now.upto):
            yield classes()

    ranges = files.repartitionByRange(n_runs, "block").sortWithinPartitions("file_id").select("file_id", "remainSize", "size")
    dealt = materialise(ranges.mapInArrow(deal, "run bigint, file_id bigint, remainSize bigint, size bigint, class bigint, upto bigint,"
                                          " leaves bigint, starts bigint, last bigint, total bigint"), "dealt")
    local = materialise(dealt.where(F.col("class").isNotNull()).drop("file_id", "remainSize", "size"), "classes")
    # One row for each run in this window and the one below.
    offsets = materialise(local.where(F.col("class") == 0).select("run", F.coalesce(F.sum(F.col("total").cast(_WIDE)).over(
        Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(_WIDE).alias("offset")), "offsets")
    nodes = materialise(local.join(offsets.hint("merge"), "run").select(
        "run", "class", "starts", *[(F.col(c) + F.col("offset")).cast(_WIDE).alias(c) for c in ("upto", "leaves", "last")]), "nodes")
    end = nodes.agg(F.max("last")).first()[0]

    # The successor of a class holds the first file with at least as many bytes before it; files of
    # size 0 tie, so the classes at one place are ordered, and the first of them counts.
    target = nodes.select(F.col("upto").alias("_at"), F.struct("run", "class").alias("node"))
    leaving = nodes.where(F.col("leaves") <= F.lit(end)).select(F.struct("run", "class").alias("from"), "leaves", "starts")
    jumps = materialise(as_of_join(leaving, target, "leaves", "_at", ["node"], forward=True)
                        .select("from", "node", F.col("leaves").alias("entered"), "starts"), "jumps")
    first = nodes.orderBy("run", "class").select(F.struct("run", "class").alias("node"), F.lit(0).cast(_WIDE).alias("entered"),
                                                   F.lit(0).cast("bigint").alias("split")).limit(1)
    chain = materialise(first, "chain")
    n = 1
    while True:
        hops = jumps.select(F.col("from").alias("node"), F.col("node").alias("to"), F.col("entered").alias("at"), "starts")
        # Merged at every size: a broadcast would send the rows through the driver once a round.
        more = chain.join(hops.hint("merge"), "node").select(F.col("to").alias("node"), F.col("at").alias("entered"),
                                               (F.col("split") + F.col("starts")).alias("split"))
        chain = materialise(chain.unionByName(more), "chain")
        was, n = n, chain.count()
        if n == was:
            break
        second = jumps.select(F.col("from").alias("mid"), F.col("node").alias("to"), F.col("entered").alias("at"), F.col("starts").alias("more"))
        jumps = materialise(jumps.join(second.hint("merge"), jumps["node"] == second["mid"])
                            .select("from", F.col("to").alias("node"), F.col("at").alias("entered"),
                                    (F.col("starts") + F.col("more")).alias("starts")), "jumps")
    # Each run takes the next place on the chain at or after its first file.
    entered = offsets.join(chain.select(F.col("node.run").alias("run"), "entered", "split").hint("merge"), "run", "left")
    ahead = Window.orderBy("run").rowsBetween(0, Window.unboundedFollowing)
    opened = entered.select("run", "offset", F.first("entered", ignorenulls=True).over(ahead).alias("entered"),
                            F.first("split", ignorenulls=True).over(ahead).alias("split"))
    last = chain.join(nodes.select(F.struct("run", "class").alias("node"), "starts").hint("merge"), "node") \
        .agg(F.max(F.col("split") + F.col("starts"))).first()[0]
    head = opened.select("run", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("file_id"),
                         F.lit(None).cast("bigint").alias("remainSize"), F.lit(None).cast("bigint").alias("size"),
                         # Bytes of the run before the next start, and the split open until then.
                         (F.col("entered") - F.col("offset")).cast("bigint").alias("start"),
                         (F.coalesce("split", F.lit(last)) - 1).alias("open"))
    body = dealt.where(F.col("class").isNull()).select(
        "run", F.lit(1).alias("kind"), "file_id", "remainSize", "size", F.lit(None).cast("bigint").alias("start"),
        F.lit(None).cast("bigint").alias("open"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, split, before = None, 0, 0
        for batch in batches:
            of_file = batch.column("kind").to_numpy() == 1
            size = batch.column("size").fill_null(0).to_numpy()
            out = np.zeros(batch.num_rows, np.int64)
            heads = np.flatnonzero(~of_file).tolist()
            for a, b in zip([-1, *heads], [*heads, batch.num_rows]):
                if a >= 0:
                    start, split, before = batch.column("start")[a].as_py(), batch.column("open")[a].as_py(), 0
                if a + 1 < b:
                    out[a + 1:b], start = number_files(size[a + 1:b], before, start, split, max_bytes)
                    split, before = int(out[b - 1]), before + int(size[a + 1:b].sum())
            rows = pa.RecordBatch.from_arrays([batch.column("file_id"), pa.array(out), batch.column("remainSize")],
                                              names=["file_id", "split_id", "remainSize"])
            yield rows.filter(pa.array(of_file))

    both = head.unionByName(body).repartition("run").sortWithinPartitions("run", "kind", "file_id")
    return both.select("kind", "file_id", "remainSize", "size", "start", "open") \
        .mapInArrow(number, "file_id bigint, split_id bigint, remainSize bigint")
