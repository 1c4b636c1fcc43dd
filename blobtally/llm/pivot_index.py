"""Embedding near-duplicates through a pivot-permutation index.

Each vector is described by its nearest pivots in order. Inverted lists hold, for every pivot,
the vectors that name it; two vectors are candidates if the lists show that they share enough
pivots, and a candidate pair is verified by its cosine in double precision. The pivots come from a bounded
sample; every vector is indexed and every vector is a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import BROADCAST_ROWS, Forest, by_key, components, materialise, small_side

MIN_COSINE = 0.9
#: Pivots that describe a vector, and how many of them a candidate pair shares. In 64 dimensions
#: a pair at the threshold shares two of twelve with probability 0.997 even among 4000 pivots.
PREFIX, MIN_SHARED = 12, 2
#: Pivots: four times the root of the number of vectors within these bounds, from a sample eight
#: times as large; pivots are less similar to each other than the last number.
PIVOTS, MAX_PIVOT_COSINE = (64, 4096), 0.5
#: Vectors of a list that meet in one block; longer lists are divided, block against block.
BLOCK = 4096


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow for very large or small components."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


def choose_pivots(distinct: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Pivots for each dimension: spread-out members of a sample by hash (bounded)."""
    want = int(min(max(PIVOTS[0], 4 * math.isqrt(n)), PIVOTS[1]))
    # About eight times as many rows as are wanted, taken where they lie.
    sizes = {r["dim"]: r["n"] for r in distinct.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    below = {d: min(int(8 * want / m * (1 << 63)), (1 << 63) - 1) for d, m in sizes.items()}
    if not below:
        return {}
    limit = F.get(F.map_values(F.map_filter(F.create_map(*[F.lit(x) for d in below.items() for x in d]),
                                            lambda k, _: k == F.col("dim"))), F.lit(0))
    sample = distinct.select(F.size("v").alias("dim"), "k1", "k2", "v").where(F.shiftrightunsigned("k1", 1) <= limit).collect()
    sample = [(r["dim"], r["v"]) for r in sorted(sample, key=lambda r: (r["k1"], r["k2"]))]
    by_dim: dict[int, list] = {}
    for dim, v in sample:
        by_dim.setdefault(dim, []).append(v)
    pivots = {}
    for dim, rows in by_dim.items():
        u = unit(np.array(rows, np.float64))
        kept = np.zeros((0, dim))
        for x in u:  # a dense group gives one pivot
            if len(kept) == want:
                break
            if not len(kept) or (kept @ x).max() < MAX_PIVOT_COSINE:
                kept = np.vstack([kept, x])
        pivots[dim] = kept
    return pivots


def _describe(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                p = pivots[int(dim)]
                sims = unit(_matrix(part.column("v"))) @ p.T
                k = min(PREFIX, len(p))
                near = np.argsort(-sims, axis=1, kind="stable")[:, :k].astype(np.int32)
                flat = pa.array(near.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, k, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("nid", "dim", "n", "v")), lists],
                                                 names=["nid", "dim", "n", "v", "pivots"])

    return run


def _pairs(starts: np.ndarray, counts: np.ndarray, most: int = 500_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for every i and the ``counts[i]`` places j from ``starts[i]`` on, in pieces."""
    at = 0
    ends = np.cumsum(counts)
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        n = counts[at:stop]
        i = np.repeat(np.arange(at, stop), n)
        yield i, np.repeat(starts[at:stop] - (np.cumsum(n) - n), n) + np.arange(len(i))
        at = stop


def candidates(sig: np.ndarray, a: np.ndarray, b: np.ndarray, single: bool, pivot: int, need: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (one of ``a``, one of ``b``) of the list of ``pivot`` that share at least ``need`` pivots,
    this one being the least of them, each pair once.

    The other pivots' postings inside the block are counted: pair by pair along their lists, or, where
    many pairs share many pivots, by products of the rows' indicators.
    """
    k = sig.shape[1]
    if need > 1:
        rows_a, rows_b = np.repeat(a, k), np.repeat(b, k)
        qa, qb = sig[a].ravel(), sig[b].ravel()
        oa, ob = np.flatnonzero(qa > pivot), np.flatnonzero(qb > pivot)
        oa, ob = oa[np.argsort(qa[oa], kind="stable")], ob[np.argsort(qb[ob], kind="stable")]
        qa, qb, ra, rb = qa[oa], qb[ob], rows_a[oa], rows_b[ob]
        starts, stops = np.searchsorted(qb, qa, "left"), np.searchsorted(qb, qa, "right")
        if single:
            starts = np.arange(len(qa)) + 1
        pivots = np.unique(sig[np.concatenate([a, b])])
        if (stops - starts).sum() * 150 <= len(a) * len(b) * len(pivots) * 0.2:
            for i, j in _pairs(starts, np.maximum(stops - starts, 0)):
                x, y, q = ra[i], rb[j], qa[i]
                same = (sig[x][:, :, None] == sig[y][:, None, :]).any(axis=2)
                # Found under the least pivot after this one, with none before it.
                lower = (same & (sig[x] < q[:, None]) & (sig[x] != pivot)).any(axis=1)
                ok = ~lower & (same.sum(axis=1) >= need)
                x, y = x[ok], y[ok]
                yield np.minimum(x, y) if single else x, np.maximum(x, y) if single else y
            return
    pivots = np.unique(sig)
    low, high = pivots[pivots < pivot], pivots[pivots > pivot]

    def indicator(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), len(of)), np.float32)
        at = np.searchsorted(of, sig[rows]) if len(of) else np.zeros((len(rows), k), np.int64)
        hit = (of[np.minimum(at, len(of) - 1)] == sig[rows]) if len(of) else np.zeros((len(rows), k), bool)
        r, c = np.nonzero(hit)
        out[r, at[r, c]] = 1
        return out

    low_b, high_b = indicator(b, low), indicator(b, high)
    for at in range(0, len(a), 512):
        rows = a[at:at + 512]
        x, y = np.nonzero((indicator(rows, high) @ high_b.T >= need - 1) & (indicator(rows, low) @ low_b.T == 0))
        x, y = rows[x], b[y]
        if single:
            x, y = x[x < y], y[x < y]
        yield x, y


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, parts in by_key(batches, "cell"):
        t = pa.concat_tables(list(parts))  # at most two blocks
        pivot = t.column("pivot")[0].as_py()
        need = min(MIN_SHARED, len(t.column("pivots")[0]))
        nid, mult, right = (t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("nid", "n", "right"))
        u, sig = unit(_matrix(t.column("v"))), _matrix(t.column("pivots")).astype(np.int32)
        single = t.column("bi")[0].as_py() == t.column("bj")[0].as_py()
        a = np.arange(len(nid)) if single else np.flatnonzero(~right)
        b = a if single else np.flatnonzero(right)
        forest, links = Forest(len(nid)), np.zeros(len(nid), np.int64)
        for x, y in candidates(sig, a, b, single, pivot, need):
            for at in range(0, len(x), 100_000):
                i, j = x[at:at + 100_000], y[at:at + 100_000]
                ok = np.einsum("ij,ij->i", u[i], u[j]) >= MIN_COSINE
                i, j = i[ok], j[ok]
                np.add.at(links, i, mult[j])
                np.add.at(links, j, mult[i])
                forest.join(i, j)
        hit = links > 0
        yield pa.RecordBatch.from_arrays([pa.array(nid[hit]), pa.array(links[hit]), pa.array(nid[forest.label][hit])],
                                         names=["nid", "links", "root"])


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Links, component and verdict for every vector.

    Returns vec_id, n_links (other rows linked directly), component_id (least vec_id reachable)
    and kept (vec_id = component_id). Equal vectors are one node that counts its rows, so copies
    cost no pairs. A vector that is null, empty, zero or has a null or non-finite component
    links with nothing, equal rows included; vectors of different length do not link. Rows with
    a null id link but cannot name a component: kept is false for them, and component_id is null
    where no member has an id. Repeated ids are rows of their own. Empty in, empty out.
    """
    v = vectors[vector].cast("array<double>")
    rows = vectors.select(vectors[id_column].alias("vec_id"), vectors[vector].alias("v"), _usable(v).alias("ok"))
    rows = rows.select("vec_id", "v", "ok", F.when(F.col("ok"), F.xxhash64("v")).alias("k1"),
                       F.when(F.col("ok"), F.xxhash64(F.lit(1), "v")).alias("k2"))
    nodes = rows.where("ok").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    nodes = materialise(nodes.withColumn("nid", F.monotonically_increasing_id()), "vectors")
    n = nodes.count()
    pivots = choose_pivots(nodes, n)

    described = nodes.select("nid", F.size("v").alias("dim"), "n", "v").repartition("nid") \
        .mapInArrow(_describe(pivots), nodes.select("nid", F.size("v").alias("dim"), "n", "v",
                                                    F.array(F.lit(0)).alias("pivots")).schema)
    described = materialise(described, "permutations")
    posted = described.withColumn("pivot", F.explode("pivots"))
    blocks = posted.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocks = materialise(blocks, "pivot_lists")
    mine = F.pmod(F.xxhash64("nid", "pivot"), F.col("blocks")).cast("int")
    posted = posted.join(small_side(blocks, blocks.count(), BROADCAST_ROWS), ["dim", "pivot"]).withColumn("block", mine)
    posted = posted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    posted = posted.select("nid", "n", "v", "pivots", "pivot", F.least("block", "other").alias("bi"),
                           F.greatest("block", "other").alias("bj"), (F.col("block") > F.col("other")).alias("right"), "dim")
    # A cell is a pair of blocks of one list.
    cell = F.concat_ws(",", "dim", "pivot", "bi", "bj")
    found = posted.withColumn("cell", cell).repartition("cell").sortWithinPartitions("cell") \
        .mapInArrow(_verify, "nid long, links long, root long")
    found = materialise(found, "vector_links")
    comp = components(found.where("nid != root").select(F.col("nid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("nid").agg(F.sum("links").alias("links"))
    rooted = nodes.select("nid", "k1", "k2", "least", "n").join(comp.withColumnRenamed("node", "nid"), "nid", "left") \
        .join(links, "nid", "left").withColumn("component", F.coalesce("component", "nid"))
    rooted = materialise(rooted, "vector_roots")
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "component").select("k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.select("vec_id", "ok", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
