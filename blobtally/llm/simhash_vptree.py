"""SimHash near-duplicates through vantage-point trees.

A tree over a bounded sample of the distinct fingerprints divides Hamming space into shards:
each node has a vantage point and a radius, near points go one way and far points the other. A
fingerprint lives in one shard and also queries every shard of a lower number that the triangle
inequality cannot rule out, so each pair within the distance meets in exactly one shard. A shard
prunes its block of comparisons by vantage points of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import Forest, by_key, components, materialise, small_side

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints aimed at in a shard, and the largest sample a tree is built from.
SHARD_SIZE, MAX_SAMPLE = 32_768, 65_536
_BLOCK = 1 << 16


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned 64-bit integer; zero for null or no word.

    ``bytes.lower`` and ``bytes.split`` know just the ASCII letters and the six ASCII
    white-space characters, which are those of the definition.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = words[at:at + _BLOCK + shingle - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        m = min(_BLOCK, n - at)
        stops = ends[min(shingle, len(part)) - 1:][:m] - 1
        h = np.array([xxhash.xxh64_intdigest(line[i:j], SEED)
                      for i, j in zip(starts[:m].tolist(), stops.tolist())], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text, shingle: int = SHINGLE):
    """Column of fingerprints (signed long with the same bits) for a text column."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        got = np.array([fingerprint_of(t, shingle) for t in texts], np.uint64)
        return pd.Series(got.view(np.int64))

    return of(F.col(text).cast("binary"))


class Tree:
    """Vantage-point tree as arrays; a leaf has no vantage point and a shard number."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.nodes: list[tuple] = []
        self.shards = 0
        self._grow(sample, leaves)

    def _grow(self, sample: np.ndarray, leaves: int) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        if leaves > 1 and len(sample) > 1:
            d = np.bitwise_count(sample ^ sample[0])
            mu = int(np.median(d))
            near = d <= mu
            if near.all():
                mu -= 1
                near = d <= mu
            if near.any() and not near.all():
                rest = sample[1:] if near[1:].any() else sample
                d, near = d[-len(rest):], near[-len(rest):]
                a = self._grow(rest[near], leaves // 2)
                b = self._grow(rest[~near], leaves - leaves // 2)
                self.nodes[me] = (sample[0], mu, a, b)
                return me
        self.nodes[me] = (None, self.shards, 0, 0)
        self.shards += 1
        return me

    def visit(self, fps: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, indexes of the fingerprints whose ball reaches into it)."""
        todo = [(0, np.arange(len(fps)))]
        while todo:
            node, idx = todo.pop()
            vp, mu, a, b = self.nodes[node]
            if vp is None:
                yield mu, idx
                continue
            d = np.bitwise_count(fps[idx] ^ vp).astype(np.int16)
            for child, inside in ((a, d <= mu + radius), (b, d > mu - radius)):
                if inside.any():
                    todo.append((child, idx[inside]))


def close_pairs(q: np.ndarray, h: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into q, into h) within ``bits``, in blocks, pruned by triangle bounds."""
    todo = [(np.arange(len(q)), np.arange(len(h)))]
    while todo:
        i, j = todo.pop()
        if len(i) * len(j) <= _BLOCK * 8 or len(j) <= 512:
            for at in range(0, len(i), max(1, (1 << 20) // max(1, len(j)))):
                k = i[at:at + max(1, (1 << 20) // max(1, len(j)))]
                x, y = np.nonzero(np.bitwise_count(q[k][:, None] ^ h[j][None, :]) <= bits)
                if len(x):
                    yield k[x], j[y]
            continue
        vp = h[j[len(j) // 2]]
        dj = np.bitwise_count(h[j] ^ vp).astype(np.int16)
        di = np.bitwise_count(q[i] ^ vp).astype(np.int16)
        mu = int(np.median(dj))
        near = dj <= mu
        if near.all():
            near = dj <= (mu := mu - 1)
        if not near.any():  # all at one distance from the vantage point
            k = len(j) // 2
            keep = np.abs(di - dj[0]) <= bits
            todo += [(i[keep], j[:k]), (i[keep], j[k:])]
            continue
        todo += [(i[di <= mu + bits], j[near]), (i[di > mu - bits], j[~near])]


def _route(tree: Tree, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            home = np.zeros(len(fps), np.int32)
            for shard, idx in tree.visit(fps, 0):  # at radius 0 near and far exclude each other
                home[idx] = shard
            for shard, idx in tree.visit(fps, bits):
                idx = idx[home[idx] >= shard]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(idx), shard, np.int32)), pa.array(home[idx] > shard),
                     pa.array(fps[idx].view(np.int64))], names=["shard", "guest", "fp"])

    return run


def _search(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars(nodes: np.ndarray, label: np.ndarray, at: int):
            mine = np.arange(at, len(nodes))
            mine = mine[label[mine] != mine]
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes[mine].view(np.int64)), pa.array(nodes[label[mine]].view(np.int64))], names=["a", "b"])

        for _, parts in by_key(batches, "shard"):
            home, forest = np.zeros(0, np.uint64), Forest(0)
            guests_began = False
            for part in parts:  # the home rows come first, then the guests stream by
                fps = part.column("fp").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
                guest = part.column("guest").combine_chunks().to_numpy(zero_copy_only=False)
                home = np.concatenate([home, fps[~guest]])
                if not guest.any():
                    continue
                if not guests_began:
                    guests_began = True
                    forest.grow(len(home))
                    for a, b in close_pairs(home, home, bits):
                        forest.join(a, b)
                q = fps[guest]
                forest.grow(len(home) + len(q))
                for a, b in close_pairs(q, home, bits):
                    forest.join(a + len(home), b)
                yield stars(np.concatenate([home, q]), forest.label, len(home))
                forest.shrink(len(home))
            if not guests_began:
                forest.grow(len(home))
                for a, b in close_pairs(home, home, bits):
                    forest.join(a, b)
            yield stars(home, forest.label, 0)

    return run


def links(distinct: DataFrame, n: int, bits: int = MAX_BITS) -> DataFrame:
    """Star edges (a, b) that join every pair of ``distinct(fp)`` within ``bits`` of each other.

    The sample that shapes the tree is bounded and at most an eighth of the input; it decides
    only where the shards' borders run, never which pairs are found.
    """
    spark = distinct.sparkSession
    leaves = max(1, -(-n // SHARD_SIZE))
    size = min(MAX_SAMPLE, n // 8, 256 * leaves)
    picked = [r[0] for r in distinct.orderBy(F.xxhash64("fp")).limit(size).collect()] if leaves > 1 else []
    tree = Tree(np.array(picked, np.int64).view(np.uint64), min(leaves, max(1, len(picked) // 16)))
    routed = distinct.select("fp").mapInArrow(_route(tree, bits), "shard int, guest boolean, fp long")
    parts = max(tree.shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return routed.repartition(parts, "shard").sortWithinPartitions("shard", "guest") \
        .mapInArrow(_search(bits), "a long, b long")


def _grouped(docs: DataFrame, bits: int, shingle: int, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """Written rows (row, id, number, fp), and (fp, component, component_id).

    The component is one of the group's fingerprints, the component_id its least id.
    """
    rows = materialise(docs.select(
        F.struct(*[docs[c] for c in carry]).alias("row"), docs["doc_id"].alias("id"),
        F.monotonically_increasing_id().alias("number"), fingerprints("text", shingle).alias("fp")), "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint_nodes")
    comp = components(links(nodes, nodes.count(), bits))
    rooted = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("component", "fp").alias("component"))
    rooted = materialise(rooted, "fingerprint_roots")
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows, rooted.join(least, "component").select("fp", "component", "component_id")


def simhash_groups(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE,
                   carry: list[str] | None = None) -> DataFrame:
    """Group documents whose fingerprints are linked by steps of at most ``bits`` bits.

    Returns the columns ``carry`` (all by default) with fingerprint (16 hex digits) and
    component_id, the least doc_id of the group. Text null, empty or without a word: fingerprint
    zero, linked like any other. Rows with a null doc_id belong to their group but cannot name
    it; a group of only such rows has a null component_id. Repeated rows share a group. Equal
    fingerprints are one node, so copies cost one row each and no pairs.
    """
    carry = docs.columns if carry is None else carry
    rows, groups = _grouped(docs, bits, shingle, carry)
    return rows.join(groups, "fp") \
        .select(*[F.col("row")[c].alias(c) for c in carry if c not in ("fingerprint", "component_id")],
                F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """One document of each group: that with the least doc_id, one row of it.

    A group of rows that all have a null doc_id keeps one of its rows.
    """
    rows, groups = _grouped(docs, bits, shingle, docs.columns)
    named = rows.select("id", "number", "fp").join(groups, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = materialise(named.groupBy("component").agg(F.min("number").alias("number")).select("number"), "kept_documents")
    one = rows.join(small_side(kept, kept.count()), "number", "left_semi")
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns])
