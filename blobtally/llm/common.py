"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blobtally.session import scratch_path

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
#: A side of a join is broadcast only below this many rows, which are counted first.
BROADCAST_ROWS = 300_000
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_scopes: list[list[str]] = []


@contextmanager
def collect_tables() -> Iterator[list[str]]:
    """The paths of the tables that ``materialise`` writes inside the block."""
    tables: list[str] = []
    _scopes.append(tables)
    try:
        yield tables
    finally:
        _scopes.remove(tables)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that ``materialise`` wrote and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    This cuts the lineage with a copy every executor can read, so a lost executor costs the
    tasks that were running and nothing before them. The shuffle files of the write go as it ends;
    else they stay until the driver happens to collect its garbage.
    """
    path = scratch_path(df.sparkSession, name)
    for tables in _scopes:
        tables.append(path)
    conf = df.sparkSession.conf
    before = conf.get(_DROP_SHUFFLES)
    conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_DROP_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a counted side for broadcast if it holds at most ``limit`` rows, else leave it be."""
    return F.broadcast(df) if rows <= limit else df


def spaced(text: Column) -> Column:
    """The text with every white-space character turned into a space (same length)."""
    for c in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def spaced_words(text: Column) -> Column:
    """The words of a text whose only white space is the space."""
    return F.array_remove(F.split(text, " "), "")


def words(text: Column) -> Column:
    """All words of a text; an empty array for null."""
    return spaced_words(spaced(F.coalesce(text, F.lit(""))))


def with_values(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns through a one-row generator.

    Plain projections may be merged, which would evaluate a costly expression again for every
    element of a lambda that refers to it; a generator is never merged.
    """
    fields = F.struct(*[v.alias(k) for k, v in values.items()])
    return df.select("*", F.inline_outer(F.array(fields)))


def runs(keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal values, and the length as the last entry."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def by_key(batches: Iterator[pa.RecordBatch], key: str, piece: int = 1 << 62
           ) -> Iterator[tuple[object, Iterator[pa.Table]]]:
    """Groups of consecutive rows with one key, over sorted Arrow batches.

    A group comes as an iterator of slices (at most one per incoming batch), so that a caller
    that streams holds one batch however long the group is. Every group must be read to its end.
    """
    source = iter(batches)
    state: dict = {"rest": None, "done": False}

    def fill() -> bool:
        while state["rest"] is None or state["rest"].num_rows == 0:
            nxt = next(source, None)
            if nxt is None:
                return False
            state["rest"] = pa.Table.from_batches([nxt])
        return True

    def group(value) -> Iterator[pa.Table]:
        while fill():
            rest = state["rest"]
            col = rest.column(key).combine_chunks()
            head = np.flatnonzero(np.asarray(col.to_numpy(zero_copy_only=False)) != value)
            n = int(head[0]) if len(head) else rest.num_rows
            if n == 0:
                return
            state["rest"] = rest.slice(n)
            for at in range(0, n, piece):
                yield rest.slice(at, min(piece, n - at))
            if len(head):
                return

    while fill():
        value = state["rest"].column(key)[0].as_py()
        members = group(value)
        yield value, members
        for _ in members:
            pass


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding(op: Callable, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over every window of ``width`` entries, by doubling."""
    if width > len(x):
        return x[:0]
    have, out = 1, x
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    more = width - have
    return op(out[:len(out) - more], out[more:]) if more else out


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the minimum of at least one window of ``width`` entries.

    Ties count for every position that holds the minimum.
    """
    low = sliding(np.minimum, h, width)
    if not len(low):
        return np.zeros(0, np.int64)
    pad = np.zeros(width - 1, h.dtype)
    best = sliding(np.maximum, np.concatenate([pad, low, pad]), width)
    return np.flatnonzero(best == h)


class Forest:
    """Least-label sets over 0..n-1, joined by arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def grow(self, n: int) -> None:
        self.label = np.concatenate([self.label, np.arange(len(self.label), n)])

    def shrink(self, n: int) -> None:
        """Forget the entries from ``n`` on; roots are least labels, so the rest stay whole."""
        self.label = self.label[:n]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        lab = self.label
        while len(a):
            ra, rb = lab[a], lab[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if not len(a):
                break
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            np.minimum.at(lab, high, low)
            while True:  # every entry to its root
                up = lab[lab]
                if np.array_equal(up, lab):
                    break
                lab[:] = up


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, component)``.

    The component is its least node; nodes without an edge do not appear. Large-star and
    small-star steps alternate, each one aggregation and one join, and every round is written to
    the shared folder. No neighbour list is ever collected, so a hub only makes its rows many.
    An empty edge table gives an empty result.
    """
    def least(pairs: DataFrame) -> DataFrame:
        low = pairs.groupBy("a").agg(F.min("b").alias("low")) \
            .select("a", F.least("a", "low").alias("low"))
        return pairs.join(low, "a")

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = edges.where(F.col("a") != F.col("b")) \
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with collect_tables() as old:
        now = materialise(now, "edges")
    seen = state(now)
    for _ in range(max_rounds if seen[0] else 0):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = least(both).where(F.col("b") > F.col("a")) \
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small = least(large)
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")) \
            .union(small.select("a", F.col("low").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        with collect_tables() as new:
            now = materialise(small, "edges")
        was, seen = seen, state(now)
        drop_tables(edges.sparkSession, old)
        old = new
        if was == seen:
            break
    else:
        if seen[0]:
            raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    stars = now.groupBy("a").agg(F.min("b").alias("b"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .union(stars.select(F.col("b").alias("a"), F.col("b").alias("b")).distinct())
