"""Best-fit packing of documents into bins under conflicts.

A document of more than a bin's capacity fills whole bins, and its rest is packed like a short
document. Bins are ordered by what room they have left. A bin carries bitmaps of the sources
that have reached their quota in it and of the duplicate clusters it holds; the successor search
starts at the least room that is enough and goes on to more room until a bin has no conflict.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import by_key, materialise, words

#: Words in a bin, documents of one source in a bin, and words of a shard, packed by one task.
CAPACITY, SOURCE_QUOTA, SHARD_WORDS = 2048, 8, 4_000_000


class Bins:
    """Open bins of one shard, by room and then by the bitmap of sources at their quota."""

    def __init__(self, capacity: int, quota: int):
        self.capacity, self.quota = capacity, quota
        self.rooms: list[int] = []  # ascending, each with at least one open bin
        self.open: dict[int, dict[int, list[int]]] = {}
        self.room: list[int] = []
        self.full_sources: list[int] = []  # a bitmap for each bin
        self.held: list[int] = []  # a bitmap of clusters for each bin
        self.counts: list[dict[int, int]] = []

    @property
    def clusters(self) -> list[set[int]]:
        """The clusters in each bin."""
        return [{c for c in range(bits.bit_length()) if bits >> c & 1} for bits in self.held]

    def _file(self, b: int) -> None:
        room = self.room[b]
        if room <= 0:
            return
        if room not in self.open:
            self.open[room] = {}
            insort(self.rooms, room)
        self.open[room].setdefault(self.full_sources[b], []).append(b)

    def _successor(self, need: int, source: int, cluster: int | None) -> int | None:
        bit = 1 << source
        for at in range(bisect_left(self.rooms, need), len(self.rooms)):
            room = self.rooms[at]
            groups = self.open[room]
            for bitmap, bins in groups.items():
                if bitmap & bit:
                    continue
                for k in range(len(bins) - 1, -1, -1):
                    b = bins[k]
                    if cluster is None or not self.held[b] >> cluster & 1:
                        bins.pop(k)
                        if not bins:
                            del groups[bitmap]
                        if not groups:
                            del self.open[room]
                            self.rooms.pop(at)
                        return b
        return None

    def place(self, need: int, source: int, cluster: int | None) -> tuple[int, int]:
        """(bin, offset) of a piece of ``need`` words."""
        b = self._successor(need, source, cluster)
        if b is None:
            b = len(self.room)
            self.room.append(self.capacity)
            self.full_sources.append(0)
            self.held.append(0)
            self.counts.append({})
        offset = self.capacity - self.room[b]
        self.room[b] -= need
        n = self.counts[b][source] = self.counts[b].get(source, 0) + 1
        if n >= self.quota:
            self.full_sources[b] |= 1 << source
        if cluster is not None:
            self.held[b] |= 1 << cluster
        self._file(b)
        return b, offset


def _pack(capacity: int, quota: int):
    out_names = ["who", "copy", "shard", "bin", "piece", "first_word", "offset", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in by_key(batches, "shard"):
            bins, sources, clusters, rows = Bins(capacity, quota), {}, {}, []
            for part in parts:  # longest first
                cols = [part.column(n).to_pylist() for n in ("who", "copy", "n_words", "source", "cluster")]
                for who, copy, n, source, cluster in zip(*cols):
                    source = sources.setdefault(source, len(sources))
                    if cluster is not None:
                        cluster = clusters.setdefault(cluster, len(clusters))
                    at = piece = 0
                    while n - at > 0 or piece == 0:
                        take = min(capacity, n - at)
                        b, offset = bins.place(take, source, cluster) if take else (-1, 0)
                        rows.append((who, copy, shard, b, piece, at, offset, take))
                        at, piece = at + take, piece + 1
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=out_names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=out_names)

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, quota: int = SOURCE_QUOTA, cluster: str | None = None,
         shard_words: int = SHARD_WORDS, carry: list[str] | None = None) -> DataFrame:
    """Place every document in bins of ``capacity`` words.

    Returns the columns ``carry`` (doc_id by default) with, for each piece: shard and bin (a
    bin's number is unique within its shard), piece, first_word (of the piece in the document),
    offset (in the bin) and n_words, all long. No bin holds two pieces of one duplicate cluster
    or more than ``quota`` pieces of a source. ``cluster`` names a column with the cluster;
    without it, documents that are equal but for ASCII case and white space are a cluster.

    Documents are dealt to shards of about ``shard_words`` words by a hash; a hot source or
    cluster is spread over all of them, and packs as tightly as its quota lets it. A document
    without a word (null or empty text) gets one piece without words and bin -1. Null source: a
    source of its own. Null cluster: in conflict with none. Ties in length go by a hash of the
    row; equal rows are placed each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    carry = ["doc_id"] if carry is None else carry
    base = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs["source"].cast("string").alias("source"),
                       words(docs["text"]).alias("w"),
                       (docs[cluster] if cluster else F.lit(None)).alias("given"))
    own = F.when(F.size("w") > 0, F.xxhash64(F.lower(F.array_join("w", " "))))
    base = base.select("row", "source", F.size("w").cast("long").alias("n_words"),
                       (F.when(F.col("given").isNotNull(), F.xxhash64("given")) if cluster else own).alias("cluster"))
    base = base.withColumn("who", F.xxhash64("row", "cluster", "n_words"))
    base = base.withColumn("copy", F.monotonically_increasing_id())
    base = materialise(base, "packing_documents")
    total = base.agg(F.sum("n_words")).first()[0] or 0
    n_shards = max(1, -(-int(total) // shard_words))
    dealt = base.select("who", "copy", "n_words", "source", "cluster",
                        F.pmod(F.xxhash64("copy", "who"), F.lit(n_shards)).alias("shard"))
    parts = max(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = dealt.repartition(parts, "shard").sortWithinPartitions("shard", F.desc("n_words"), "who", "copy") \
        .mapInArrow(_pack(capacity, quota), "who long, copy long, shard long, bin long, piece long, "
                                            "first_word long, offset long, n_words long")
    out = base.select("row", "copy").join(placed, "copy")
    made = ["shard", "bin", "piece", "first_word", "offset", "n_words"]
    return out.select(*[F.col("row")[c].alias(c) for c in carry if c not in made], *made)
