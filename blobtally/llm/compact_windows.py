"""Near-duplicate passages by compact windows.

A document is a sequence of five-word shingles. Under one hash function, the Cartesian tree of
the shingles' hashes gives for every position c the widest range l..r in which c holds the least
hash: all subsequences i..j with l <= i <= c <= j <= r share that minimum, and one row stands for
all of them. Only ranges as long as the shortest passage count, about 2n/T of n positions.
Windows with equal minima are paired with the first of their kind, pairs of windows of several
hash functions that overlap in both documents (the interval join) give candidate passages, and
these are verified on their words: five-word shingles, Jaccard similarity of 0.8 or more.
The first of a kind may share no more than a shingle. Minima that lie in no verified passage are
therefore grouped again, by the shingles around them and by each run of 50 words over them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blobtally.llm.common import (
    WORD,
    collect_tables,
    drop_tables,
    materialise,
    mix64,
    runs,
    small_side,
    window_minima,
    with_values,
    words,
)

SHINGLE, MIN_WORDS, MIN_SIMILARITY = 5, 50, 0.8
#: Hash functions, and how many of them must agree on a passage before it is verified. A passage
#: at similarity s collides under each with probability s: at 0.8, 2 of 5 is reached by 99.3 %;
#: an exact repeat collides under all.
N_HASHES, MIN_HASHES = 5, 2
#: Matched shingles further apart than this belong to different passages.
MAX_GAP = 10
#: Runs of shingles (before the minimum, length) that group open windows again, besides those of
#: the length of the shortest passage; lengths are powers of two.
_CONTEXTS = ((0, 8), (7, 8), (8, 16))
#: A run of 16 shingles or more over a minimum holds one of this length that ends or starts there.
_NEAR = 8
_BLOCK_WORDS = 200_000
#: Pairs of windows that a sweep looks at together.
_BLOCK_PAIRS = 500_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)
_SEEDS = mix64(np.arange(1, 65, dtype=np.uint64) * _ODD[0])


def _word_hashes(words_: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words_), np.uint64, len(words_))


def shingle_hashes(words_: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words."""
    return _hashes_of_runs(_word_hashes(words_), size)


def _hashes_of_runs(w: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    n = len(w) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.zeros(n, np.uint64)
    for i in range(size):
        x = mix64(x + w[i:i + n] * _ODD[i % len(_ODD)])
    return x


def shingle_ids(words_: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """64-bit numbers of all runs of ``size`` words that tell them apart, in a quarter of the steps of
    ``shingle_hashes``; their order says nothing, so they are for comparing only."""
    n = len(words_) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    w = _word_hashes(words_)
    x = w[:n] * _ODD[0]
    for i in range(1, size):
        x += w[i:i + n] * _ODD[i % len(_ODD)]
    return x


def _in_a_row(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingle hashes of documents (given as word hashes) with an entry before, between and behind
    them, where each document starts, and which entries are such barriers."""
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    x = np.concatenate([np.zeros(1, np.uint64), _hashes_of_runs(np.concatenate(parts)), np.zeros(SHINGLE - 1, np.uint64)])
    barrier, keep = np.zeros(len(x), bool), np.ones(len(x), bool)
    barrier[0] = True
    barrier[ends - SHINGLE + 2] = True
    x[barrier] = 0
    for i in range(SHINGLE - 2):  # shingles that run on into the next document
        keep[ends - i] = False
    starts = 1 + np.cumsum(sizes - SHINGLE + 2) - (sizes - SHINGLE + 2)
    return x[keep], starts, barrier[keep]


def compact_windows(x: np.ndarray, barrier: np.ndarray, seed: np.uint64, width: int):
    """(hash, c, l, r) of all compact windows of at least ``width`` shingles.

    ``x`` holds the shingles of many documents and ``barrier`` is true at the entries between
    them, the first and the last one included. Of equal minima in a range the leftmost counts.
    """
    h = mix64(x ^ seed) | np.uint64(1)
    h[barrier] = 0
    least = barrier.copy()
    least[window_minima(h, width)] = True
    at = np.flatnonzero(least)
    v = h[at]
    left, right = np.arange(len(at)) - 1, np.arange(len(at)) + 1
    inner = np.flatnonzero(v)
    todo = inner
    while len(todo):  # to the nearest entry on the left that is not greater
        todo = todo[v[left[todo]] > v[todo]]
        left[todo] = left[left[todo]]
    todo = inner
    while len(todo):  # to the nearest entry on the right that is smaller
        todo = todo[v[right[todo]] >= v[todo]]
        right[todo] = right[right[todo]]
    c, l, r = at[inner], at[left[inner]] + 1, at[right[inner]] - 1
    wide = r - l + 1 >= width
    return v[inner][wide], c[wide], l[wide], r[wide]


def _folded(key: np.ndarray, own: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Rows of one key within a block point to the first of them here, and only that one takes
    part in the shuffle by key (with what its document has of that key besides): a frequent
    passage arrives once for each block. Such rows are dealt at random and keep their key.
    ``own`` holds uid, at, and what else a row carries."""
    order = np.argsort(key)
    edges = runs(key[order])
    many = np.repeat(np.diff(edges) > 1, np.diff(edges))
    tied = order[many]
    order[many] = tied[np.lexsort((own[1][tied], own[0][tied], key[tied]))]
    key, own = key[order], [z[order] for z in own]
    uid, at = own[:2]
    first = np.repeat(edges[:-1], np.diff(edges))
    rest = uid[first] != uid
    slot = np.where(rest, mix64((uid ^ at).view(np.uint64)).view(np.int64), key)
    rep = pa.StructArray.from_arrays([*(pa.array(z[first]) for z in own), pa.array(key)],
                                     [*names, "key"], mask=pa.array(~rest))
    return pa.RecordBatch.from_arrays([pa.array(slot), *map(pa.array, own), rep], names=["slot", *names, "rep"])


def _around(near: np.ndarray, c: np.ndarray, l: np.ndarray, r: np.ndarray) -> np.ndarray:
    """16 bits each of the runs of shingles that end and that start at the minima; 0 for a run
    that leaves its window."""
    out = np.zeros(len(c), np.uint32)
    for start, shift in ((c - _NEAR + 1, 16), (c, 0)):
        ok = (start >= l) & (start + _NEAR - 1 <= r)
        out[ok] |= (near[start[ok]] >> np.uint64(48) | np.uint64(1)).astype(np.uint32) << np.uint32(shift)
    return out.view(np.int32)


def _windows(width: int):
    def block(ids: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        x, starts, barrier = _in_a_row(parts)
        near = _run_hashes(x, set(), _NEAR)[_NEAR]
        got = []
        for f in range(N_HASHES):
            key, c, l, r = compact_windows(x, barrier, _SEEDS[f], width)
            doc = np.searchsorted(starts, c, "right") - 1
            got.append((key.view(np.int64), np.asarray(ids, np.int64)[doc],
                        (c - starts[doc]) * 64 + f, ((c - l) << 32) + (r - c), _around(near, c, l, r)))
        key, *own = (np.concatenate(z) for z in zip(*got))
        return _folded(key, own, ["uid", "at", "reach", "around"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                split = (text.as_py() or b"").lower().split()
                n = len(split) - SHINGLE + 1
                if n < width:
                    continue
                ids.append(uid)
                parts.append(_word_hashes(split))
                held += n
                if held >= _BLOCK_WORDS:
                    yield block(ids, parts)
                    ids, parts, held = [], [], 0
        if ids:
            yield block(ids, parts)

    return run


_ROW = "slot long, uid long, at long, reach long, rep struct<uid: long, at: long, reach: long, key: long>"
_WINDOW_ROW = "slot long, uid long, at long, reach long, around int, " \
              "rep struct<uid: long, at: long, reach: long, around: int, key: long>"


def _paired(rows: DataFrame) -> DataFrame:
    """Each row but the first of its slot, by uid and place, with that first one; rows that know
    theirs keep it.

    Rows of the first one's own document are paired too.
    """
    own = [c for c in rows.columns if c not in ("slot", "rep")]
    slot = Window.partitionBy("slot").orderBy("uid", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    led = rows.select("*", *[F.first(c).over(slot).alias(f"first_{c}") for c in own])
    known = F.col("rep").isNotNull()
    later = (F.col("uid") != F.col("first_uid")) | (F.col("at") != F.col("first_at"))
    return led.where(known | later).select(
        *own, *[F.when(known, F.col("rep")[c]).otherwise(F.col(f"first_{c}")).alias(f"rep_{c}") for c in own],
        F.when(known, F.col("rep")["key"]).otherwise(F.col("slot")).alias("key"))


def _run_hashes(x: np.ndarray, lengths: set[int], width: int) -> dict[int, np.ndarray]:
    """Hashes of all runs of the lengths given (powers of two) and of ``width`` shingles."""
    out, h, n = {}, mix64(x + _ODD[1]), 1
    while n * 2 <= width:
        h = mix64(h[:-n] * _ODD[0] + h[n:]) if len(h) > n else h[:0]
        n *= 2
        if n in lengths:
            out[n] = h
    more = width - n
    out[width] = mix64(h[:len(h) - more] * _ODD[2] + h[more:]) if more else h
    return out


def _open_rows(width: int):
    """Rows (uid, windows (at, reach), text) to rows keyed by the runs of shingles around the
    minima; ``at`` and ``reach`` become the first and the last shingle of the window."""
    functions = mix64(np.arange(64, dtype=np.uint64))

    def keyed(ids: list[int], windows: list[pa.StructArray], parts: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
        """The rows in the order of the documents, and where those of each one end."""
        x, starts, _ = _in_a_row(parts)
        runs_ = _run_hashes(x, {n for _, n in _CONTEXTS}, width)
        doc = np.repeat(np.arange(len(ids)), [len(w) for w in windows])
        at, reach = (np.concatenate([w.field(i).to_numpy() for w in windows]) for i in (0, 1))
        c, f = at // 64 + starts[doc], at % 64
        l, r = c - (reach >> 32), c + (reach & 0xFFFFFFFF)
        got = []
        for kind, (before, n) in enumerate(_CONTEXTS):
            s = c - before
            ok = (s >= l) & (s + n - 1 <= r)
            k = mix64(runs_[n][s[ok]] ^ _SEEDS[8 + kind] ^ functions[f[ok]])
            got.append(np.stack([k.view(np.int64), doc[ok], l[ok], r[ok]]))
        # Every run of the shortest length over a minimum. A run has one minimum under each function,
        # and equal runs have it at the same place, so one function brings them all.
        doc, c, l, r = doc[f == 0], c[f == 0], l[f == 0], r[f == 0]
        lo, hi = np.maximum(l, c - width + 1), np.minimum(c, r - width + 1)
        n = hi - lo + 1
        s = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        got.append(np.stack([runs_[width][s].view(np.int64), np.repeat(doc, n), np.repeat(l, n), np.repeat(r, n)]))
        got = np.concatenate(got, axis=1)
        key, doc, l, r = got[:, np.argsort(got[1], kind="stable")]
        ends = np.cumsum(np.bincount(doc, minlength=len(ids))).tolist()
        return np.stack([key, np.asarray(ids, np.int64)[doc], l - starts[doc], r - starts[doc]]), ends

    def folded(held: list[np.ndarray]) -> pa.RecordBatch:
        key, *own = np.concatenate(held, axis=1)
        return _folded(key, own, ["uid", "at", "reach"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
        docs: tuple[list, list, list] = [], [], []
        held = 0
        for batch in batches:
            for uid, windows, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                docs[0].append(uid)
                docs[1].append(windows.values)
                docs[2].append(_word_hashes(text.as_py().lower().split()))
                held += len(docs[2][-1])
                if held >= _BLOCK_WORDS // 8:
                    yield docs
                    docs, held = ([], [], []), 0
        if held:
            yield docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for docs in blocks(batches):
            rows, ends = keyed(*docs)
            start = 0
            for end in ends:
                if size + end - start >= _BLOCK_WORDS:
                    yield folded([*held, rows[:, start:end]])
                    held, size, start = [], 0, end
            held.append(rows[:, start:])
            size += ends[-1] - start
        if size:
            yield folded(held)

    return run


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (uid, at): passages on which enough hash functions agree.

    Two windows of different functions support each other if some subsequence of the document
    lies in both; if they point to the same source, the same must hold there. Near copies of
    near copies have several sources, which is why the support may come from another one.
    """
    names = ["uid", "lo", "hi", "rep_uid", "rep_lo", "rep_hi"]

    def complete(t: np.ndarray) -> pa.RecordBatch:
        uid, at, reach, rep, rep_at, rep_reach = t
        f = at % 64
        ends = []
        for a, s in ((at, reach), (rep_at, rep_reach)):
            c = a // 64
            ends.append((c, c - (s >> 32), c + (s & 0xFFFFFFFF)))
        # Every window goes back through those before it, as far as it reaches to the left.
        found = [np.zeros((6, 0), np.int64)]
        votes = [np.zeros((3, 0), np.int64)]
        c, l, r = ends[0]
        doc = np.cumsum(np.concatenate([[0], uid[1:] != uid[:-1]])) << 40
        row = np.arange(len(uid))
        n = row - np.searchsorted(doc + c, doc + l)
        total = np.cumsum(n)
        cuts = np.unique(np.searchsorted(total, np.arange(0, total[-1] + _BLOCK_PAIRS, _BLOCK_PAIRS), "right"))
        for s, e in zip([0, *cuts], [*cuts, len(uid)]):
            b = np.repeat(row[s:e], n[s:e])
            a = b - 1 - (np.arange(len(b)) - np.repeat(total[s:e] - n[s:e] - (total[s] - n[s] if e > s else 0), n[s:e]))
            hit = (f[a] != f[b]) & (c[b] <= r[a])
            a, b = a[hit], b[hit]
            ok = np.ones(len(a), bool)
            same = rep[a] == rep[b]
            boxes = []
            for side, (mid, left, right) in enumerate(ends):
                lo, hi = np.maximum(left[a], left[b]), np.minimum(right[a], right[b])
                over = (lo <= np.minimum(mid[a], mid[b])) & (np.maximum(mid[a], mid[b]) <= hi)
                ok &= over | ~same if side else over
                boxes.append((lo, hi))
            _, left, right = ends[1]
            for one, other in ((a, b), (b, a)):
                votes.append(np.stack([one, f[other], one])[:, ok])
                found.append(np.stack([uid[one], *boxes[0], rep[one], np.where(same, boxes[1][0], left[one]),
                                       np.where(same, boxes[1][1], right[one])])[:, ok])
        z, votes = np.concatenate(found, axis=1), np.concatenate(votes, axis=1)
        # A window counts if it and the functions that support it are enough.
        support = np.bincount(np.unique(votes[0] * 64 + votes[1]) // 64, minlength=len(uid)) + 1
        z = z[:, support[votes[2]] >= MIN_HASHES]
        z = z[:, np.lexsort((z[1], z[3], z[0]))]
        if z.shape[1]:  # overlapping candidates of a pair become one
            new = np.ones(z.shape[1], bool)
            same = (z[0][1:] == z[0][:-1]) & (z[3][1:] == z[3][:-1])
            group = np.cumsum(np.concatenate([[True], ~same]))
            far = np.maximum.accumulate(z[2] + group * (1 << 40)) - group * (1 << 40)
            new[1:] = ~same | (z[1][1:] > far[:-1])
            b = np.flatnonzero(new)
            z = np.stack([z[0][b], z[1][b], np.maximum.reduceat(z[2], b), z[3][b],
                          np.minimum.reduceat(z[4], b), np.maximum.reduceat(z[5], b)])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in z], names=names)

    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = np.stack([batch.column(i).to_numpy() for i in range(6)])
        if not held or held[0][0, 0] != t[0, -1]:
            t = np.concatenate([*held, t], axis=1)
            changed = np.flatnonzero(t[0][1:] != t[0][:-1])
            cut = changed[-1] + 1 if len(changed) else 0
            if cut:
                yield complete(t[:, :cut])
            held = [t[:, cut:]]
        else:
            held.append(t)  # still the same document
    if held:
        yield complete(np.concatenate(held, axis=1))


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; on short arrays a plain sort beats ``np.unique``."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which entries of ``x`` are in ``ordered``, a sorted array."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def verified(a: list[bytes], b: list[bytes]) -> Iterator[tuple[int, int, int, int, float]]:
    """Passages (start, end, start in b, end in b, similarity) of ``a`` that ``b`` has too.

    Ends are exclusive word positions. Matched shingles that stand close together make a
    passage; if that is not similar enough, it is cut where its partner is, on both sides in turn,
    and each pair of parts is compared; last, its unbroken parts are tried.
    """
    return _alike(shingle_ids(a), shingle_ids(b))


def _spans(hit: np.ndarray, gap: int, least: int) -> list[tuple[int, int]]:
    """Stretches of ``least`` entries or more whose hits stand no further apart than ``gap``."""
    p = hit.nonzero()[0]
    if not len(p):
        return []
    cuts = (p[1:] - p[:-1] > gap).nonzero()[0]
    starts, ends = [int(p[0]), *p[cuts + 1].tolist()], [*p[cuts].tolist(), int(p[-1])]
    return [(s, e + 1) for s, e in zip(starts, ends) if e + 1 - s >= least]


def _alike(xa: np.ndarray, xb: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """``verified`` on the numbers of the shingles."""
    need = MIN_WORDS - SHINGLE + 1
    if np.array_equal(xa, xb):
        if len(xa) >= need:
            yield 0, len(xa) + SHINGLE - 1, 0, len(xb) + SHINGLE - 1, 1.0
        return
    # The shingles are numbered from 0, so that sets of them are marks in an array.
    known = _distinct(np.concatenate([xa, xb]))
    xa, xb = np.searchsorted(known, xa), np.searchsorted(known, xb)

    def marks(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(known), bool)
        out[x] = True
        return out

    def likeness(mine: np.ndarray, n: int, x: np.ndarray) -> float:
        other = marks(x)
        both = np.count_nonzero(other & mine)
        return both / (n + np.count_nonzero(other) - both)

    def partner(s: int, e: int, gap: int):
        mine = marks(xa[s:e])
        n, best = np.count_nonzero(mine), None
        for u, v in _spans(mine[xb], gap, need):
            j = likeness(mine, n, xb[u:v])
            if best is None or j > best[2]:
                best = (u, v, j)
        return best

    def aligned(s: int, e: int) -> dict[tuple[int, int], tuple[int, int, float]]:
        """Parts of a span that are similar enough to a part of the other side, with the best one."""
        out: dict[tuple[int, int], tuple[int, int, float]] = {}
        todo, seen = [(s, e, 0, len(xb))], set()
        while todo:
            s, e, u, v = todo.pop()
            for p, q in _spans(marks(xb[u:v])[xa[s:e]], MAX_GAP, need):
                mine = marks(xa[s + p:s + q])
                for y, z in _spans(mine[xb[u:v]], MAX_GAP, need):
                    pair = (s + p, s + q, u + y, u + z)
                    if pair != (s, e, u, v):
                        if pair not in seen:
                            seen.add(pair)
                            todo.append(pair)
                        continue
                    j = likeness(mine, np.count_nonzero(mine), xb[u:v])
                    if j >= MIN_SIMILARITY and ((s, e) not in out or j > out[s, e][2]):
                        out[s, e] = (u, v, j)
        return out

    hit = marks(xb)[xa]
    for s, e in _spans(hit, MAX_GAP, need):
        best = partner(s, e, MAX_GAP)
        if best and best[2] >= MIN_SIMILARITY:
            yield s, e + SHINGLE - 1, best[0], best[1] + SHINGLE - 1, best[2]
            continue
        parts = aligned(s, e)
        for (p, q), (u, v, j) in sorted(parts.items()):
            yield p, q + SHINGLE - 1, u, v + SHINGLE - 1, j
        for p, q in _spans(hit[s:e], 1, need):
            if not any(u <= s + p and s + q <= v for u, v in parts):
                best = partner(s + p, s + q, 1)
                if best and best[2] >= MIN_SIMILARITY:
                    yield s + p, s + q + SHINGLE - 1, best[0], best[1] + SHINGLE - 1, best[2]


def _once(made: Callable[[list[bytes]], Sequence]):
    """A function of (uid, text) that gives what ``made`` makes of the words; the last document's
    is kept."""
    last: list = [None, []]

    def get(uid: int, text: pa.BinaryScalar) -> Sequence:
        if last[0] != uid:
            last[:] = uid, made(text.as_py().lower().split())
        return last[1]

    return get


def _cut_source(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates with the source's text, in its order, to candidates with the words in question."""
    split = _once(list)
    for batch in batches:
        meta = [batch.column(n).to_pylist() for n in ("rep_uid", "rep_lo", "rep_hi")]
        part = [b" ".join(split(uid, text)[s:e + SHINGLE]) for uid, s, e, text in zip(*meta, batch.column("text"))]
        kept = ["uid", "lo", "hi", "rep_uid", "rep_lo"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(part, pa.binary())],
                                         names=[*kept, "source"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["uid", "lo", "hi", "rep_uid", "rep_lo"]
    numbered = _once(shingle_ids)
    for batch in batches:
        out = []
        meta = [batch.column(n).to_pylist() for n in fields]
        for uid, lo, hi, rep, rep_lo, source, text in zip(*meta, batch.column("source"), batch.column("text")):
            for s, e, u, v, j in _alike(numbered(uid, text)[lo:hi + 1], shingle_ids(source.as_py().split())):
                out.append((uid, rep, lo + s, lo + e, rep_lo + u, rep_lo + v, j))
        cols = list(zip(*out)) or [[]] * 7
        types = [pa.int64()] * 6 + [pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[
            "uid", "rep_uid", "start_word", "end_word", "source_start", "source_end", "similarity"])


def _with_uid(docs: DataFrame) -> DataFrame:
    """Add ``uid``: the doc_id, or a negative number where that is null or not unique."""
    bad = materialise(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null or doc_id < 0")
                      .select(F.col("doc_id").alias("bad"), F.lit(True).alias("is_bad")), "repeated_ids")
    marked = docs.join(small_side(bad, bad.count()), docs["doc_id"].eqNullSafe(F.col("bad")), "left")
    fresh = -1 - F.monotonically_increasing_id()
    return marked.withColumn("uid", F.when(F.col("is_bad"), fresh).otherwise(F.col("doc_id"))).drop("bad", "is_bad")


def _digest():
    return F.unhex(F.md5("text")).alias("digest")


def _passages(base: DataFrame) -> DataFrame:
    """Verified passages between rows of ``base(uid, text, digest)``, a written table."""
    width = MIN_WORDS - SHINGLE + 1
    # Of equal texts the least uid stands for all; whole copies are reported from here, and only
    # one of them goes on.
    given = base.where(F.col("digest").isNotNull())
    copies = given.groupBy("digest") \
        .agg(F.min("uid").alias("rep_uid"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = given.select("uid", "digest") \
        .join(copies, "digest").where(F.col("uid") != F.col("rep_uid")).select("uid", "rep_uid")
    copies = materialise(copies, "copies")
    n_copies = copies.count()
    # Words are counted behind the join: a plain filter by them would be moved below it, to all texts.
    whole = with_values(base.join(small_side(copies, n_copies), "uid").select("uid", "rep_uid", "text"),
                        n=F.size(words(F.col("text"))).cast("long")).where(F.col("n") >= MIN_WORDS)
    whole = whole.select("uid", "rep_uid", F.lit(0).cast("long").alias("start_word"), F.col("n").alias("end_word"),
                         F.lit(0).cast("long").alias("source_start"), F.col("n").alias("source_end"),
                         F.lit(1.0).alias("similarity"))
    texts = given.join(small_side(copies.select("uid"), n_copies), "uid", "left_anti") \
        .select("uid", F.col("text").cast("binary").alias("text"))

    windows = texts.mapInArrow(_windows(width), _WINDOW_ROW)
    with collect_tables() as tables:
        pairs = materialise(_paired(windows), "window_pairs")
    linked = pairs.where(F.col("uid") != F.col("rep_uid"))
    regions = linked.select("uid", "at", "reach", "rep_uid", "rep_at", "rep_reach") \
        .repartition("uid").sortWithinPartitions("uid", "at") \
        .mapInArrow(_regions, "uid long, lo long, hi long, rep_uid long, rep_lo long, rep_hi long")
    found = materialise(_checked(texts, regions), "passages_of_first")

    # Windows whose minimum lies in no passage found: all that have their hash, the firsts and
    # those in passages too, are grouped again by what stands around it.
    inside = found.select(F.col("uid").alias("in_uid"), "start_word", "end_word")
    c = F.expr("at div 64")
    still = linked.select("uid", "at", "key").join(inside, (F.col("uid") == F.col("in_uid")) & (c >= F.col("start_word"))
                                                   & (c + SHINGLE <= F.col("end_word")), "left_anti")
    still = materialise(still.select("key").distinct(), "open_keys")
    n_open = still.count()
    if n_open:
        again = _open_windows(pairs.join(small_side(still, n_open), "key", "left_semi"))
        drop_tables(base.sparkSession, tables)
        n_windows = again.agg(F.sum(F.size("windows"))).first()[0] or 0
        rows = texts.join(small_side(again, n_windows), "uid").select("uid", "windows", "text").mapInArrow(_open_rows(width), _ROW)
        regions = _paired(rows).where(F.col("uid") != F.col("rep_uid")).groupBy("uid", "rep_uid").agg(
            F.min("at").alias("lo"), F.max("reach").alias("hi"),
            F.min("rep_at").alias("rep_lo"), F.max("rep_reach").alias("rep_hi"))
        regions = materialise(regions.select("uid", "lo", "hi", "rep_uid", "rep_lo", "rep_hi"), "regions_of_all")
        more = _checked(texts, regions)
        found = _widest(materialise(found.union(more), "passages_of_all"))
    return materialise(whole.union(found).distinct(), "passages")


def _open_windows(pairs: DataFrame) -> DataFrame:
    """(uid, windows) of the windows in ``pairs`` that a second grouping could pair.

    Every run it looks at holds the eight shingles that end or start at the minimum. Windows
    that share neither of the two with another one of their hash have nothing to be paired by.
    """
    names = ["uid", "at", "reach", "around"]
    rows = pairs.select("key", *names).union(
        pairs.select("key", *[F.col(f"rep_{n}").alias(n) for n in names]).distinct())
    sides = F.array(*[F.when(part != 0, F.xxhash64("key", F.lit(i), part)) for i, part in enumerate(
        (F.shiftrightunsigned("around", 16), F.col("around").bitwiseAND(0xFFFF)))])
    rows = rows.select("uid", "at", "reach", F.explode(sides).alias("side")).where(F.col("side").isNotNull())
    with collect_tables() as tables:
        rows = materialise(rows, "open_sides")
    shared = materialise(rows.groupBy("side").count().where("count > 1").select("side"), "shared_sides")
    rows = rows.join(small_side(shared, shared.count()), "side", "left_semi")
    out = materialise(rows.groupBy("uid").agg(F.collect_set(F.struct("at", "reach")).alias("windows")), "open_windows")
    drop_tables(pairs.sparkSession, tables)
    return out


def _widest(found: DataFrame) -> DataFrame:
    """Of passages of one pair of documents, those that lie in no longer one, each once."""
    source = F.struct("similarity", "source_start", "source_end")
    one = found.groupBy("uid", "rep_uid", "start_word", "end_word").agg(F.max(source).alias("m")) \
        .select("uid", "rep_uid", "start_word", "end_word", "m.source_start", "m.source_end", "m.similarity")
    wide = found.select(F.col("uid").alias("w_uid"), F.col("rep_uid").alias("w_rep"),
                        F.col("start_word").alias("w_start"), F.col("end_word").alias("w_end"))
    inside = (F.col("uid") == F.col("w_uid")) & (F.col("rep_uid") == F.col("w_rep")) \
        & (F.col("start_word") >= F.col("w_start")) & (F.col("end_word") <= F.col("w_end")) \
        & (F.col("end_word") - F.col("start_word") < F.col("w_end") - F.col("w_start"))
    return one.join(wide, inside, "left_anti")


def _checked(texts: DataFrame, regions: DataFrame) -> DataFrame:
    """Verified passages in candidate ``regions(uid, lo, hi, rep_uid, rep_lo, rep_hi)``.

    The words in question of the source go to the later document, whose text stays whole. Both
    joins deal by the document, so texts are dealt once; a document that many need is split by
    the skew handling of the join. What the first one cuts is written, so that the texts dealt for
    it are off the disk before the second one deals them.
    """
    by_source = texts.withColumnRenamed("uid", "rep_uid").join(regions.hint("merge"), "rep_uid")
    cut = by_source.select("uid", "lo", "hi", "rep_uid", "rep_lo", "rep_hi", "text") \
        .mapInArrow(_cut_source, "uid long, lo long, hi long, rep_uid long, rep_lo long, source binary")
    cut = materialise(cut, "source_words")
    ready = texts.join(cut.hint("merge"), "uid").select("uid", "lo", "hi", "rep_uid", "rep_lo", "source", "text")
    return ready.mapInArrow(_verify, "uid long, rep_uid long, start_word long, end_word long, "
                                      "source_start long, source_end long, similarity double")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages of 50 words or more that an earlier document has too, exactly or nearly.

    One row for each passage and source: doc_id, source_doc_id, start_word, end_word,
    source_start, source_end (word positions, ends exclusive), n_words, similarity. Earlier
    means a lower doc_id; of a passage in many documents each one points to an earlier one, not
    to all. A document that equals an earlier one as a whole gives one row. Null, empty and
    short texts have no passage. Documents whose doc_id is null or repeated come before the
    others, in any order, and are reported by that doc_id.
    """
    base = materialise(_with_uid(docs.select("doc_id", "text")).select("*", _digest()), "documents_by_uid")
    found = _passages(base.select("uid", "text", "digest"))
    odd = base.where(F.col("uid") < 0).select("uid", "doc_id")
    out = found
    for key, name in (("uid", "doc_id"), ("rep_uid", "source_doc_id")):
        given = odd.select(F.col("uid").alias(key), F.col("doc_id").alias(name))
        out = out.join(given, key, "left").withColumn(name, F.when(F.col(key) < 0, F.col(name)).otherwise(F.col(key)))
    return out.select("doc_id", "source_doc_id", "start_word", "end_word", "source_start", "source_end",
                      (F.col("end_word") - F.col("start_word")).alias("n_words"), "similarity")


def _without(text: str | None, spans) -> str | None:
    """The text without the words in the spans and the white space behind them."""
    if spans is None or text is None:
        return text
    at = [m.start() for m in re.finditer(WORD, text)] + [len(text)]
    out, here = [], 0
    for s, e in sorted((x["start_word"], x["end_word"]) for x in spans):
        if at[s] > here:
            out.append(text[here:at[s]])
        here = max(here, at[e])
    return "".join([*out, text[here:]])


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the passages that earlier ones have; same columns.

    ``text`` loses the passages and ``n_chars``, if there is one, follows it. A document of
    which no word is left goes; one that had no word to begin with stays.
    """
    full = docs.select(F.struct(*docs.columns).alias("row"), "doc_id")
    base = _with_uid(full).withColumn("text", F.col("row")["text"]).select("row", "uid", _digest())
    base = materialise(base, "documents_by_uid").withColumn("text", F.col("row")["text"])
    found = _passages(base.select("uid", "text", "digest"))
    spans = materialise(found.groupBy("uid").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans")), "repeats")
    n_spans = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    cut = base.join(small_side(spans, n_spans), "uid", "left")

    @F.pandas_udf("string")
    def without(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_without(t, s) for t, s in zip(text, spans)], dtype=object)

    cut = cut.withColumn("new", without("text", "spans"))
    kept = cut.where(F.col("spans").isNull() | F.col("new").rlike(WORD))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.col("new"))
    values = {c: F.col("row")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(F.col("spans").isNull(), F.col("row")["n_chars"]) \
            .otherwise(F.length("new").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[values[c].alias(c) for c in docs.columns])
