"""Document fingerprints by Order MinHash.

A text's elements are its k-mers of code points with their occurrence numbers. Each of the hash
functions selects the elements with the smallest values, puts them back into text order and hashes
that tuple to one component. The share of equal components of two texts falls with their edit
distance: unlike a plain MinHash it notices when the same k-mers stand in another order.

``edited_fingerprints`` also fingerprints every text after its last quarter was replaced by the
head of the next document. The documents are dealt once, compressed, into ranges of (doc_id, text
hash); each range also gets the first document of the one after it, and is then read as a stream.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import materialise, mix64

#: Length of a k-mer, elements in a tuple, components of a fingerprint (8 hex digits each).
K, TUPLE, COMPONENTS = 6, 2, 32
#: Bytes of text in a range, and sampled keys for each range when its bounds are chosen.
RANGE_BYTES, KEYS_PER_RANGE = 64 << 20, 16
#: Elements hashed at a time, and how many times the needed elements are let through a bound first.
_BLOCK, _ROOM = 4096, 6

#: The hash functions: products of the low 32 bits of an element's hash with odd numbers.
_FACTORS = (np.random.default_rng(11).integers(0, 1 << 31, COMPONENTS, dtype=np.int64) * 2 + 1).astype(np.uint32)
_PRIME, _STEP = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)

RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def elements(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of (k-mer, occurrence number), the k-mers' hashes and their positions.

    A text shorter than a k-mer is one k-mer itself; the empty text has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    width = min(K, len(points))
    n = len(points) - width + 1 if width else 0
    kmer = np.full(n, width, np.uint64)
    for j in range(width):
        kmer = kmer * _PRIME + points[j:j + n]
    kmer = mix64(kmer)
    # Equal k-mers side by side, in text order: the position takes the low bits of the sort key.
    low = np.uint64(max(n, 1).bit_length())
    key = np.sort(kmer >> low << low | np.arange(n, dtype=np.uint64))
    at = (key & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    kmer, same = kmer[at], key >> low
    first = np.ones(n, bool)
    first[1:] = same[1:] != same[:-1]
    place = np.arange(n)
    occurrence = place - np.maximum.accumulate(np.where(first, place, 0))
    return kmer + occurrence.astype(np.uint64) * _STEP, kmer, at


def _true_places(mask: np.ndarray) -> np.ndarray:
    """Flat places of the few true entries; eight are looked at together first."""
    flat = mask.ravel()
    whole = len(flat) & ~7
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    r, c = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    return np.concatenate([words[r] * 8 + c, whole + np.flatnonzero(flat[whole:])])


def _smallest(base: np.ndarray) -> np.ndarray:
    """For each component the indices of its ``TUPLE`` smallest elements (fewer elements: all)."""
    n, low = len(base), base.astype(np.uint32)
    take = min(TUPLE, n)

    def ranked(bound: int) -> np.ndarray | None:
        which, value, index = [], [], []
        for start in range(0, n, _BLOCK):
            block = low[start:start + _BLOCK]
            v = block[None, :] * _FACTORS[:, None]
            at = _true_places(v <= np.uint32(bound))
            r = at // len(block)
            which.append(r)
            value.append(v.ravel()[at])
            index.append(at - r * len(block) + start)
        which, index = np.concatenate(which), np.concatenate(index)
        count = np.bincount(which, minlength=COMPONENTS)
        if count.min() < take:
            return None
        order = np.argsort(which.astype(np.uint64) << np.uint64(32) | np.concatenate(value), kind="stable")
        begin = np.concatenate([[0], np.cumsum(count)[:-1]])
        return index[order[begin[:, None] + np.arange(take)]]

    full = (1 << 32) - 1
    bound = min(full, (_ROOM * TUPLE << 32) // n)
    while (picked := ranked(bound)) is None:  # one component had too few below the bound
        bound = min(full, bound * 4)
    return picked


def sketch(text: str) -> np.ndarray:
    """Order MinHash of a text: ``COMPONENTS`` unsigned 32-bit integers, all zero for the empty text."""
    base, kmer, at = elements(text)
    if not len(base):
        return np.zeros(COMPONENTS, np.uint32)
    picked = _smallest(base)
    picked = np.take_along_axis(picked, np.argsort(at[picked], axis=1), axis=1)
    out = np.arange(COMPONENTS, dtype=np.uint64) + np.uint64(1)
    for j in range(picked.shape[1]):
        out = mix64(out * _PRIME + kmer[picked[:, j]])
    return (out >> np.uint64(32)).astype(np.uint32)


def fingerprint(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components: 1 for equal texts, 0 between an empty text and any other."""
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the head of the next one."""
    gone = len(text) // 4
    return text[:len(text) - gone] + following[:gone]


Key = tuple[bool, int, int]


def _keys(batch: pa.RecordBatch) -> list[Key]:
    return [(i is not None, i or 0, h) for i, h in zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist())]


def _heads(keys: DataFrame, bounds: list[Key]) -> dict[Key, list[int]]:
    """For the least key of every range, the range before it (of the first range: the last)."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, Key] = {}
        for batch in batches:
            for key in _keys(batch):
                piece = bisect_right(bounds, key)
                if piece not in low or key < low[piece]:
                    low[piece] = key
        if low:
            has, ids, hs = zip(*low.values())
            yield pa.RecordBatch.from_pydict({"piece": pa.array(low, pa.int32()), "has": pa.array(has), "id": pa.array(ids, pa.int64()),
                                              "h": pa.array(hs, pa.int64())})

    found = keys.mapInArrow(least, "piece int, has boolean, id bigint, h bigint") \
        .groupBy("piece").agg(F.min(F.struct("has", "id", "h")).alias("k")).orderBy("piece").collect()
    heads: dict[Key, list[int]] = {}
    for r, before in zip(found, [found[-1], *found] if found else []):
        heads.setdefault(tuple(r["k"]), []).append(before["piece"])
    return heads


def edited_fingerprints(docs: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Fingerprint every text of ``docs(doc_id long, text)`` and its edited text; other columns are ignored.

    Returns one row per row: doc_id, n_chars (long, code points), edited_sha256, fingerprint,
    edited_fingerprint (hex strings), near_edited and near_next (double, 0 to 1): likeness to the edited
    text's fingerprint and to the next document's.

    The next document is the next in order of doc_id; after the last comes the first. Null ids come
    first; rows of one id go by a hash of the text, so equal rows follow each other. A null text
    is an empty one. A single row is its own next document. An empty table gives an empty result.
    The ranges' bounds and first keys are what the driver holds (``KEYS_PER_RANGE`` keys each).
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    keys = materialise(docs.select("doc_id", "h", F.octet_length("text").cast("bigint").alias("size")), "keys")
    rows, size = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not rows:
        return spark.createDataFrame([], RESULT)
    n_ranges = n_ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # A key is sampled by its hash, so equal rows are sampled together and counted once.
    share = min(1.0, KEYS_PER_RANGE * n_ranges / rows)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id", "h"), 1) <= F.lit(min(int(share * (1 << 63)), (1 << 63) - 1))
    sample = sorted((i is not None, i or 0, h) for i, h in keys.where(drawn).select("doc_id", "h").distinct().collect())
    bounds = sorted({sample[len(sample) * i // n_ranges] for i in range(1, n_ranges)}) if sample else []
    heads = _heads(keys.select("doc_id", "h"), bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        sent: set[Key] = set()
        for batch in batches:
            rows: dict[tuple[Key, str], list] = {}
            for key, text in zip(_keys(batch), batch.column("text").to_pylist()):
                if (key, text) in rows:  # equal rows leave a batch as one with their number
                    rows[key, text][-1] += 1
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                packed = codec.compress(raw, asbytes=True)
                rows[key, text] = [bisect_right(bounds, key), False, *key, len(raw), packed, 1]
                if key in heads and key not in sent:
                    sent.add(key)
                    for before in heads[key]:
                        rows[key, before] = [before, True, *key, len(raw), packed, 1]
            for some in _slices(list(rows.values())):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), DEALT)], names=NAMES)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        piece, open_, out = None, None, []

        def close(text: str, values: np.ndarray) -> None:
            """Rows of the open document, now that the one after it is known."""
            doc_id, own, mine, n = open_
            for following, its, times in ((own, mine, n - 1), (text, values, 1)):
                if times:
                    new = edited(own, following)
                    print_ = sketch(new)
                    row = (doc_id, len(own), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(mine),
                           fingerprint(print_), likeness(mine, print_), likeness(mine, its))
                    out.extend([row] * times)

        for batch in batches:
            for i in range(batch.num_rows):
                at, last, has, id_, _, size, packed, n = (batch.column(c)[i].as_py() for c in NAMES)
                text = codec.decompress(packed, size, asbytes=True).decode("utf-8", "surrogatepass") if size else ""
                doc_id = id_ if has else None
                if at != piece:
                    if open_:
                        raise RuntimeError(f"range {piece} has no row after its last")
                    piece = at
                elif open_ and not last and open_[0] == doc_id and open_[1] == text:
                    open_[3] += n
                    continue
                if open_ is None and last:
                    continue  # the first copy closed the range
                values = sketch(text)
                if open_:
                    close(text, values)
                open_ = None if last else [doc_id, text, values, n]
                if len(out) >= 512:
                    yield from _result(out)
                    out = []
        yield from _result(out)

    dealt = docs.mapInArrow(deal, "piece int, last boolean, has boolean, id bigint, h bigint, size bigint, packed binary, n bigint")
    return dealt.repartitionById(n_ranges, F.col("piece")).sortWithinPartitions("piece", "last", "has", "id", "h") \
        .mapInArrow(edit, RESULT)


NAMES = ["piece", "last", "has", "id", "h", "size", "packed", "n"]
DEALT = [pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]


def _slices(rows: list, most: int = 512) -> Iterator[list]:
    for at in range(0, len(rows), most):
        yield rows[at:at + most]


def _result(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    for some in _slices(rows):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)
