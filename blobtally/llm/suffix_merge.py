"""Exact repeated substrings through a common-prefix-aware distributed merge sort of suffixes.

Not every suffix has to be sorted. The minimum of the hashes in a window picks sample positions
(anchors) that depend on content alone, so two equal strings of the sought length hold an anchor
at the same place. Anchors whose context occurs but once drop out by a count. The suffixes at the
others are sorted in each task into runs, cut by the hash of their first bytes into ranges, and
exchanged front-coded: each as the length of the prefix it shares with its predecessor, and the
rest. A loser tree merges the runs of a range; it compares known common prefixes first and bytes
only beyond them. Neighbours in the merged order then tell, with their common prefixes to the
right of the anchor and to the left, which strings of the sought length occur again.

A band of an anchor is the strings that begin from ``shift`` to ``shift + reach`` bytes left of
it. All strings of a band hold the LENGTH - reach bytes from there on, its key, so equal strings
have equal keys. The whole band's key is the anchor's gram. Where more anchors share a key than a
range should hold, the band is halved: its halves have longer keys, which few anchors share unless
all they cover is equal, and of those one stands for all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import BROADCAST_ROWS, by_key, materialise, mix64, small_side, window_minima

LENGTH, GRAM = 200, 32
#: Suffixes in a run of a task (a 16-bit count), and aimed at in a range of the merge.
RUN_SIZE, RANGE_SIZE = 20_000, 20_000
_CHUNK = 1 << 18
_REACH = LENGTH - GRAM  # how far left of its anchor a string may begin


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every position, by doubling."""
    h = mix64(data.astype(np.uint64) + np.uint64(1))
    width, odd = 1, np.uint64(0x9E3779B97F4A7C15)
    while width < GRAM:
        h = mix64(h[:-width] * odd + h[width:]) if len(h) > width else h[:0]
        width *= 2
    return h


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(position, gram hash) of the anchors; every LENGTH bytes hold at least one."""
    out_at, out_h = [], []
    for at in range(0, max(len(text) - LENGTH + 1, 0), _CHUNK):
        data = np.frombuffer(text, np.uint8, min(_CHUNK + LENGTH - 1, len(text) - at), at)
        h = gram_hashes(data)
        p = window_minima(h, _REACH + 1)
        out_at.append(p + at)
        out_h.append(h[p])
    if not out_at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    p, h = np.concatenate(out_at), np.concatenate(out_h)
    p, first = np.unique(p, return_index=True)
    return p, h[first]


def _text_anchors(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[int, bytes]], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts (uid, bytes) of a batch with their anchors: (number of the text, position, gram hash)."""
    # Short texts side by side, so that a call of numpy has many bytes to work on.
    held, size = [], 0

    def found():
        sizes = np.array([len(t) for _, t in held])
        starts = np.cumsum(sizes) - sizes
        p, h = anchors(b"".join(t for _, t in held))
        doc = np.searchsorted(starts, p, "right") - 1
        inside = p + GRAM <= starts[doc] + sizes[doc]
        return held, doc[inside], (p - starts[doc])[inside], h[inside]

    for uid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        t = text.as_py()
        if t is None or len(t) < LENGTH:
            continue
        held.append((uid, t))
        size += len(t)
        if size >= _CHUNK:
            yield found()
            held, size = [], 0
    if held:
        yield found()


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for held, doc, at, gram in _text_anchors(batch):
            uids = np.array([i for i, _ in held], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(uids[doc]), pa.array(at), pa.array(gram.view(np.int64))],
                                             names=["uid", "at", "key"])


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, given that ``known`` bytes agree."""
    n = min(len(a), len(b))
    step = 16
    while known < n and a[known:known + step] == b[known:known + step]:
        known += step
        step *= 2
    known = min(known, n)
    if known == n:
        return n
    for i in range(known, min(n, known + step)):
        if a[i] != b[i]:
            return i
    return min(n, known + step)


def neighbours(strings: list[bytes]) -> list[int]:
    """Common prefix of each of the sorted strings with the one before; 0 for the first."""
    return [0, *(common_prefix(a, b) for a, b in zip(strings, strings[1:]))] if strings else []


def merge_runs(streams: list[list[bytes]], lcps: list[list[int]]) -> Iterator[tuple[bytes, int, int, int]]:
    """Merge sorted runs with a loser tree: (string, common prefix with the last, run, index).

    ``lcps`` holds each run's common prefixes with the predecessor. A node keeps the loser and
    its common prefix with the winner that passed it. Of two strings that both follow the last
    output, the one that shares more with it comes first; only if they share the same are bytes
    compared, and then from there on.
    """
    k = 1
    while k < len(streams):
        k *= 2
    at = [0] * k
    heads: list[bytes | None] = [s[0] if s else None for s in streams] + [None] * (k - len(streams))
    loser = [0] * k
    share = [0] * k  # of the player in the leaf or the loser in the node, with the last winner

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's share becomes that with the winner."""
        x, y = heads[a], heads[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        n = common_prefix(x, y, share[a])
        first = a if n == len(x) and (n < len(y) or a < b) or n < len(x) and n < len(y) and x[n] < y[n] else b
        other = b if first == a else a
        share[other] = n
        return first, other

    winners = list(range(k))
    size = k
    while size > 1:
        half = size // 2
        for i in range(half):
            w, lose = play(winners[2 * i], winners[2 * i + 1])
            loser[half + i] = lose
            winners[i] = w
        size = half
    top = winners[0]
    while heads[top] is not None:
        yield heads[top], share[top], top, at[top]
        at[top] += 1
        run = streams[top]
        if at[top] < len(run):
            heads[top], share[top] = run[at[top]], lcps[top][at[top]]
        else:
            heads[top] = None
        node = (k + top) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2


def repeated_offsets(right: list[bytes], lcp: np.ndarray, left: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For anchors in order of their right contexts: how far left the first and the last string
    of LENGTH bytes over the anchor begin that occur over another anchor too (-1: none).

    ``left`` holds the reversed left contexts. The string that begins o bytes left of its anchor
    is equal for two anchors if their left contexts share o bytes and their right contexts
    LENGTH - o. Anchors that share a depth form runs in either order, so a pair of run numbers
    stands for the string, and no bytes are compared again.
    """
    n = len(right)
    order = np.array(sorted(range(n), key=left.__getitem__), np.int64)
    left_lcp = np.array(neighbours([left[i] for i in order]), np.int64)
    len_r = np.fromiter(map(len, right), np.int64, n)
    len_l = np.fromiter(map(len, left), np.int64, n)
    lo, hi = np.full(n, -1), np.full(n, -1)
    group = np.empty(n, np.int64)
    for o in range(int(len_l.max(initial=0)) + 1):
        live = np.flatnonzero((len_l >= o) & (len_r >= LENGTH - o))
        if len(live) < 2:
            continue
        by_right = np.cumsum(lcp < LENGTH - o)
        group[order] = np.cumsum(left_lcp < o)
        key = by_right[live] * (n + 1) + group[live]
        _, where, count = np.unique(key, return_inverse=True, return_counts=True)
        again = live[count[where] > 1]
        hi[again] = o
        lo[again] = np.where(lo[again] < 0, o, lo[again])
    return lo, hi


_PIECE = "range long, uid long, start long, stop long, run binary"


_HALF = "uid long, at long, shift int, reach int, key long, covered binary, start long, stop long"


def _halves(t: bytes, at: int, shift: int, reach: int) -> Iterator[tuple]:
    """The halves of a band: (at, shift, reach, key, digest of all bytes its strings cover, their span)."""
    half = shift + reach // 2
    for low, top in ((shift, half), (half + 1, shift + reach)):
        # Some string of the band must lie inside the text.
        if low <= at and at + LENGTH - top <= len(t):
            name = low * LENGTH + top
            key = xxhash.xxh64_intdigest(t[at - low:at + LENGTH - top], name) - (1 << 63)
            start, stop = at - min(at, top), min(at + LENGTH - low, len(t))
            yield at, low, top - low, key, hashlib.md5(b"%d %d " % (name, at - start) + t[start:stop]).digest(), start, stop


def _half_rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 8
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, types)],
                                      names=["uid", "at", "shift", "reach", "key", "covered", "start", "stop"])


def _halve_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (uid, bands of (at, shift, reach), text) to the halves of the bands."""
    for batch in batches:
        yield _half_rows([(uid, *half) for uid, bands, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
                          for b in bands for half in _halves(text.as_py(), b["at"], b["shift"], b["reach"])])


def _halve_found(levels: list[np.ndarray]):
    """Rows (uid, text) to the halves of the bands whose keys are frequent, level by level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, *deeper = levels
        deeper = [set(x.tolist()) for x in deeper]
        for batch in batches:
            for held, doc, at, gram in _text_anchors(batch):
                hot = np.isin(gram.view(np.int64), grams)
                rows = []
                for d, p in zip(doc[hot].tolist(), at[hot].tolist()):
                    uid, t = held[d]
                    bands = list(_halves(t, p, 0, _REACH))
                    for keys in deeper:
                        bands = [half for b in bands if b[3] in keys for half in _halves(t, *b[:3])]
                    rows += [(uid, *b) for b in bands]
                yield _half_rows(rows)

    return run


def _sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (uid, codes of bands, their ranges, text) to sorted, front-coded runs, one row for each run and range."""
    names = ["range", "uid", "start", "stop", "run"]

    def encode(items: list[tuple[int, bytes, bytes, int, int, int]]) -> Iterator[tuple]:
        items.sort()
        # Of anchors with the same two contexts one goes on, marked as repeated; the others are
        # known to repeat with all strings over them.
        kept, done = [], []
        i = 0
        while i < len(items):
            number, r, l, reach, uid, at = items[i]
            j = i + 1
            while j < len(items) and items[j][:4] == items[i][:4]:
                j += 1
            kept.append((number, r, l, uid, at, j - i > 1))
            if j - i > 1:
                first, last = max(0, LENGTH - len(r)), len(l)
                if first <= last:
                    done += [(uid_, at_ - last, at_ - first + LENGTH) for *_, uid_, at_ in items[i:j]]
            i = j
        for uid, start, stop in done:
            yield -1 - (uid & 0xFFFF), uid, start, stop, None
        a = 0
        while a < len(kept):
            b = a
            while b < len(kept) and kept[b][0] == kept[a][0]:
                b += 1
            part = kept[a:b]
            shared = neighbours([x[1] for x in part])
            head = np.array([[len(part), 0, 0, 0]] + [[n, len(x[1]) - n, len(x[2]), int(x[5])] for n, x in zip(shared, part)], np.uint16)
            where = np.array([[x[3], x[4]] for x in part], np.int64)
            body = b"".join(x[1][n:] + x[2] for n, x in zip(shared, part))
            yield part[0][0], 0, 0, 0, head.tobytes() + where.tobytes() + body
            a = b

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())], names=names)

    items: list[tuple[int, bytes, bytes, int, int, int]] = []
    for batch in batches:
        for uid, codes, ranges, text in zip(*(batch.column(i) for i in range(4))):
            uid, t = uid.as_py(), text.as_py()
            for code, number in zip(codes.values.to_numpy().tolist(), ranges.values.to_numpy().tolist()):
                reach = code & 255
                at = (code >> 16) - (code >> 8 & 255)
                items.append((number, t[at:at + LENGTH], t[max(0, at - reach):at][::-1], reach, uid, at))
                if len(items) >= RUN_SIZE:
                    yield out(list(encode(items)))
                    items = []
    rows = list(encode(items))
    if rows:
        yield out(rows)


def _decode(run: bytes) -> tuple[list[bytes], list[int], list[bytes], list[bool], np.ndarray]:
    n = int(np.frombuffer(run, np.uint16, 1)[0])
    head = np.frombuffer(run, np.uint16, 4 * (n + 1)).reshape(-1, 4)[1:].tolist()
    at = 8 * (n + 1)
    where = np.frombuffer(run, np.int64, 2 * n, at).reshape(-1, 2)
    at += 16 * n
    strings, shares, lefts, multi, last = [], [], [], [], b""
    for shared, rest, left, many in head:
        last = last[:shared] + run[at:at + rest]
        at += rest
        strings.append(last)
        shares.append(shared)
        lefts.append(run[at:at + left])
        multi.append(bool(many))
        at += left
    return strings, shares, lefts, multi, where


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["uid", "start", "stop"]
    for key, parts in by_key(batches, "range"):
        if key < 0:  # known before the merge
            for part in parts:
                yield from part.select(names).combine_chunks().to_batches()
            continue
        runs_ = [_decode(r.as_py()) for part in parts for r in part.column("run")]
        right, lcp, left, multi, where = [], [], [], [], []
        for string, shared, run, i in merge_runs([r[0] for r in runs_], [r[1] for r in runs_]):
            right.append(string)
            lcp.append(shared)
            left.append(runs_[run][2][i])
            multi.append(runs_[run][3][i])
            where.append(runs_[run][4][i])
        if not right:
            continue
        lo, hi = repeated_offsets(right, np.array(lcp, np.int64), left)
        many = np.array(multi)
        len_r = np.fromiter(map(len, right), np.int64, len(right))
        len_l = np.fromiter(map(len, left), np.int64, len(right))
        first = np.maximum(0, LENGTH - len_r)
        whole = many & (first <= len_l)
        lo, hi = np.where(whole, first, lo), np.where(whole, len_l, hi)
        where = np.stack(where)
        hit = hi >= 0
        yield pa.RecordBatch.from_arrays([pa.array(where[hit, 0]), pa.array(where[hit, 1] - hi[hit]),
                                          pa.array(where[hit, 1] - lo[hit] + LENGTH)], names=names)


def _shared_bands(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(uid, at, shift, reach, key) of bands whose key occurs again, and spans known to repeat.

    A key of more than RANGE_SIZE bands is halved until its bands hold one string each. Halves
    that cover the same bytes repeat as a whole, and one of them stands for all from there on.
    Few frequent keys (their number is counted) are sought in a second pass over the texts where
    they lie; beyond BROADCAST_ROWS the texts are joined with their bands.
    """
    found = materialise(texts.mapInArrow(_find_anchors, "uid long, at long, key long"), "anchors")
    band = [F.lit(0).alias("shift"), F.lit(_REACH).alias("reach")]
    out = spans = None
    levels: list[np.ndarray] | None = []
    while True:
        # Written, so that the joins below have both sides dealt for them and split a frequent key.
        often = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(band[1]).alias("reach")).where("n > 1") \
            .select("key", ((F.col("n") > RANGE_SIZE) & (F.col("reach") > 0)).alias("hot"))
        often = materialise(often, "keys")
        usual = found.join(often.where("not hot").select("key"), "key", "left_semi").select("uid", "at", *band, "key")
        out = usual if out is None else out.union(usual)
        hot = often.where("hot").select("key")
        n_hot = hot.count()
        if not n_hot:
            return out, spans
        if levels is not None and n_hot <= BROADCAST_ROWS:
            levels.append(np.array([r[0] for r in hot.collect()], np.int64))
            halves = texts.select("uid", "text").mapInArrow(_halve_found(list(levels)), _HALF)
        else:
            levels = None
            bands = found.join(small_side(hot, n_hot), "key", "left_semi").select("uid", "at", *band) \
                .groupBy("uid").agg(F.collect_list(F.struct("at", "shift", "reach")).alias("bands"))
            halves = texts.join(materialise(bands, "hot_anchors").hint("merge"), "uid").select("uid", "bands", "text") \
                .mapInArrow(_halve_joined, _HALF)
        halves = materialise(halves, "halves")
        alike = halves.groupBy("covered").agg(F.min(F.struct("uid", "at", "shift", "reach", "key")).alias("one"),
                                              F.count(F.lit(1)).alias("n"))
        alike = materialise(alike, "covered")
        found = alike.select("one.*")
        band = [F.col("shift"), F.col("reach")]
        again = alike.where("n > 1").select("covered")
        known = halves.join(small_side(again, again.count()), "covered", "left_semi").select("uid", "start", "stop")
        spans = known if spans is None else spans.union(known)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(uid, start, stop): bytes of ``texts(uid long, text binary)`` in strings that occur again.

    The spans of one uid may overlap. ``texts`` must give the same rows each time it is read.
    A range of the merge holds about RANGE_SIZE suffixes, a few times as many at most; those
    that share a key meet in one range, and suffixes of different bands never do.
    """
    spark = texts.sparkSession
    shared, known = _shared_bands(texts)
    kept = materialise(shared, "bands")
    n_ranges = max(1, -(-kept.count() // RANGE_SIZE))
    # Suffixes of different bands never meet in a range: one position may be an anchor of several.
    ranged = F.pmod(F.xxhash64("key"), F.lit(n_ranges)) * LENGTH * LENGTH + F.col("shift") * LENGTH + F.col("reach")
    code = F.col("at") * 65536 + F.col("shift") * 256 + F.col("reach")
    # Two lists of one aggregation hold its rows in the same order.
    grouped = kept.groupBy("uid").agg(F.collect_list(code).alias("codes"), F.collect_list(ranged).alias("ranges"))
    joined = texts.join(materialise(grouped, "kept_anchors").hint("merge"), "uid").select("uid", "codes", "ranges", "text")
    parts = max(n_ranges, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spans = joined.mapInArrow(_sort_runs, _PIECE) \
        .repartition(parts, "range").sortWithinPartitions("range").mapInArrow(_merge, "uid long, start long, stop long")
    return spans if known is None else spans.union(known)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove from every text the bytes in strings of 200 bytes that occur anywhere else.

    Returns doc_id, n_bytes, n_removed, n_spans (long), kept_sha256 (lower-case hex of the
    bytes that are left). Strings are judged on the input; a text that occurs twice goes as a
    whole if it has 200 bytes. Null text: empty. Repeated rows count as documents of their own.
    Empty in, empty out.
    """
    data = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    data = data.withColumn("digest", F.md5("text"))
    copies = data.where(F.length("text") >= LENGTH).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = materialise(copies.select("digest", F.lit(True).alias("copied")), "copies")
    marked = data.join(small_side(copies, copies.count()), "digest", "left")
    rows = materialise(marked.withColumn("uid", F.monotonically_increasing_id()), "texts")
    # Of equal texts only the first is searched; all of them go as a whole.
    first = rows.where("copied").groupBy("digest").agg(F.min("uid").alias("uid")).select("uid", F.lit(True).alias("is_first"))
    first = materialise(first, "first_copies")
    one = rows.join(small_side(first, first.count()), "uid", "left").where("copied is null or is_first")
    spans = repeated_spans(one.select("uid", "text"))
    spans = spans.groupBy("uid").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    @F.pandas_udf("array<struct<start: long, stop: long>>")
    def united(column: pd.Series) -> pd.Series:
        out = []
        for ss in column:
            one_: list[list[int]] = []
            for s, e in sorted((x["start"], x["stop"]) for x in ss):
                if one_ and s <= one_[-1][1]:
                    one_[-1][1] = max(one_[-1][1], e)
                else:
                    one_.append([s, e])
            out.append([{"start": s, "stop": e} for s, e in one_])
        return pd.Series(out, dtype=object)

    spans = materialise(spans.select("uid", united("spans").alias("spans")), "spans")
    n, n_spans = spans.agg(F.count(F.lit(1)), F.sum(F.size("spans"))).first()

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string")
    def cut(text: pd.Series, spans_: pd.Series, copied: pd.Series) -> pd.DataFrame:
        out = []
        for t, ss, whole in zip(text, spans_, copied):
            if whole:
                ss = [{"start": 0, "stop": len(t)}]
            here = gone = n = 0
            kept = hashlib.sha256()
            for x in ss if ss is not None else ():
                kept.update(t[here:x["start"]])
                here, n, gone = x["stop"], n + 1, gone + x["stop"] - x["start"]
            kept.update(t[here:])
            out.append((gone, n, kept.hexdigest()))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])

    out = rows.join(small_side(spans, max(n, (n_spans or 0) // 4)), "uid", "left")
    out = out.select("doc_id", F.length("text").cast("long").alias("n_bytes"),
                     cut("text", "spans", F.coalesce("copied", F.lit(False))).alias("c"))
    return out.select("doc_id", "n_bytes", "c.n_removed", "c.n_spans", "c.kept_sha256")
