"""Quality rules, passages, substrings, SimHash: brute force, ties, nulls, empty tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from blobtally.llm import compact_windows as cw
from blobtally.llm import quality_rules as qr
from blobtally.llm import simhash_vptree as sv
from blobtally.llm import suffix_merge as sm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(None, "no id here"), (3, None), (4, ""), (5, " \t\n\x0b "), (6, "one"), (6, "one"), (7, "é ü x | # !"),
       (8, "word " * 3000), (8, "a b c a b c a b c\n\na b c\r\na b c")]


def base(text):
    text = text or ""
    w = WORD.findall(text)
    three = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_quality_base_and_verdict(make_docs, prose):
    rows = ODD + [(100 + i, prose(i, 150)) for i in range(30)]
    rows += [(200, prose(200, 150).upper()), (201, " | ".join(prose(201, 150).split())),
             (202, " ".join(x + "***" for x in prose(202, 150).split())), (203, None, None, None)]
    docs = make_docs(rows, extra=["kept", "__w", "n"])
    out = qr.quality_rules(docs, carry=["doc_id", "text", "n", "__w"]).collect()
    assert len(out) == len(rows)
    for r in out:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == base(r["text"]), r["doc_id"]
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r["kept"] and r["base_failed"]) and r["n"] == "mine"
    kept = {r["doc_id"] for r in out if r["kept"]}
    assert kept == set(range(100, 130))
    good = qr.keep_good(docs)
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == kept
    assert qr.quality_rules(docs.limit(0)).count() == 0


def simhash(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, linked):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(ids))]


def test_simhash_groups(make_docs, prose, monkeypatch):
    monkeypatch.setattr(sv, "SHARD_SIZE", 16)  # many shards
    rows = list(ODD)
    for i in range(60):
        t = prose(i, 300).split()
        rows.append((1000 + i, " ".join(t)))
        t[5] = "changed"
        rows.append((2000 + i, " ".join(t)))
    docs = make_docs(rows, extra=["component_id", "fp", "row"])
    out = sv.simhash_groups(docs, carry=["doc_id", "text", "fp"]).collect()
    assert all(int(r["fingerprint"], 16) == simhash(r["text"]) and r["fp"] == "mine" for r in out)
    fps = [int(r["fingerprint"], 16) for r in out]
    root = groups(out, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    for r, g in zip(out, root):
        ids = [x["doc_id"] for x, h in zip(out, root) if h == g and x["doc_id"] is not None]
        assert r["component_id"] == (min(ids) if ids else None)
    kept = sv.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert sv.simhash_groups(docs.limit(0)).count() == 0


def test_close_pairs_is_exact():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    near = h[:500] ^ (np.uint64(1) << rng.integers(0, 63, 500).astype(np.uint64))
    pool = np.concatenate([h, near, np.full(700, 7, np.uint64)])
    want = {(i, j) for i in range(600) for j in np.flatnonzero(np.bitwise_count(pool[i] ^ pool) <= 4).tolist()}
    got = {(a, b) for x, y in sv.close_pairs(pool[:600], pool, 4) for a, b in zip(x.tolist(), y.tolist())}
    assert got == want


@pytest.mark.parametrize("width", [1, 3, 7])
def test_compact_windows_against_scan(width):
    rng = np.random.default_rng(width)
    for _ in range(25):
        docs = [rng.integers(1, 12, rng.integers(width, 40)).astype(np.uint64) for _ in range(3)]
        gap = np.zeros(1, np.uint64)
        x = np.concatenate([gap, *[y for d in docs for y in (d, gap)]])
        bar = np.zeros(len(x), bool)
        bar[np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])] = True
        _, c, lo, hi = cw.compact_windows(x, bar, cw._SEEDS[0], width)
        h = cw.mix64(x ^ cw._SEEDS[0]) | np.uint64(1)
        want = set()
        for i in np.flatnonzero(~bar):
            a = b = i
            while not bar[a - 1] and h[a - 1] > h[i]:
                a -= 1
            while not bar[b + 1] and h[b + 1] >= h[i]:
                b += 1
            if b - a + 1 >= width:
                want.add((i, a, b))
        assert want == set(zip(c.tolist(), lo.tolist(), hi.tolist()))


def test_repeated_passages(make_docs, prose):
    shared = [prose(900 + i, 60) for i in range(4)]
    rows = ODD + [(100 + i, f"{prose(i, 80)} {shared[i % 4]} {prose(500 + i, 70)}") for i in range(40)]
    rows += [(300, prose(0, 40) + " " + prose(7000, 40)), (301, rows[-1][1]), (302, rows[-1][1])]
    edited = rows[20][1].split()
    edited[100] = "other"
    rows.append((400, " ".join(edited)))
    docs = make_docs(rows, extra=["uid", "start_word", "spans"])
    out = cw.repeated_passages(docs).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
        assert r["n_words"] >= 50 and r["similarity"] >= 0.8
    texts = dict((i, t) for i, t, *_ in rows)
    for i in range(104, 140):  # the first four have each passage for the first time
        w = texts[i].split()
        s = next(k for k in range(len(w)) if w[k:k + 60] == shared[(i - 100) % 4].split())
        assert any(r["start_word"] <= s and s + 60 <= r["end_word"] for r in by[i]), i
    assert not set(by) & {100, 101, 102, 103, 300, 6, 7}
    assert {301, 302, 400} <= set(by)
    left = cw.drop_repeats(docs)
    assert left.columns == docs.columns
    got = {r["doc_id"]: r for r in left.collect()}
    assert 301 not in got and 302 not in got and got[100]["text"] == texts[100] and got[5]["text"] == " \t\n\x0b "
    assert shared[0] in got[100]["text"] and shared[0] not in got[104]["text"]
    assert got[104]["n_chars"] == len(got[104]["text"])
    assert cw.repeated_passages(docs.limit(0)).count() == 0 and cw.drop_repeats(docs.limit(0)).count() == 0


def least(words, f):
    """Position and hash of the least shingle under a function."""
    h = cw.mix64(cw.shingle_hashes([w.encode() for w in words]) ^ cw._SEEDS[f]) | np.uint64(1)
    return int(np.argmin(h)), h.min()


def test_repeat_behind_a_first_holder_of_its_shingles(make_docs, prose):
    def line_of(words):
        return words[15:35]

    def all_in_line(words):
        return all(15 <= least(words, f)[0] <= 30 for f in range(cw.N_HASHES))

    # A passage of 50 words of which all minima lie in a line of 20, and a document that has the
    # line alone, as the minima of its windows too.
    shared = next(w for w in (prose(1000 + i, 50).split() for i in range(5000)) if all_in_line(w))
    first = next(w for w in (prose(9000 + i, 15).split() + line_of(shared) + prose(19000 + i, 15).split()
                             for i in range(5000)) if all_in_line(w))
    rows = [(1, " ".join(first))] + [(i, f"{prose(60 + i, 80)} {' '.join(shared)} {prose(80 + i, 80)}") for i in (2, 3, 4)]
    out = cw.repeated_passages(make_docs(rows)).collect()
    got = {(r["doc_id"], r["source_doc_id"]): r for r in out}
    assert len(got) == len(out) and set(got) == {(3, 2), (4, 2)}
    assert all((r["start_word"], r["end_word"], r["similarity"]) == (80, 130, 1.0) for r in out)


def edited(words, step):
    return [f"edit{i}" if i % step == step // 2 else w for i, w in enumerate(words)]


def test_verified_cuts_both_sides(prose):
    x, y, more = prose(1, 200).split(), prose(2, 200).split(), prose(3, 8).split()
    a, b = edited(x + y, 45), x + more + y
    for one, other in ((a, b), (b, a)):  # words left out, and words put in
        got = list(cw.verified([w.encode() for w in one], [w.encode() for w in other]))
        assert sum(e - s for s, e, *_ in got) > 380 and len(got) == 2
        assert all(j >= 0.8 for *_, j in got)


def test_loser_tree_against_sort():
    import random
    rng = random.Random(3)
    for _ in range(60):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 12)))
                for _ in range(rng.randint(1, 7))]
        got = list(sm.merge_runs(runs, [sm.neighbours(r) for r in runs]))
        assert [g[0] for g in got] == sorted(x for r in runs for x in r)
        assert [g[1] for g in got] == sm.neighbours([g[0] for g in got])


def test_repeated_bytes_against_all_windows(make_docs, prose, monkeypatch):
    monkeypatch.setattr(sm, "RUN_SIZE", 50)
    monkeypatch.setattr(sm, "RANGE_SIZE", 60)
    shared = prose(1, 50)
    rows = ODD + [(100 + i, prose(10 + i, 60) + shared[i:] + prose(90 + i, 20 + 10 * i)) for i in range(12)]
    rows += [(200, "ab" * 400), (201, "é" * 150 + "x" + "é" * 99), (202, rows[-1][1]), (203, rows[-1][1][:199])]
    docs = make_docs(rows, extra=["digest", "copied", "text_"])
    _check_removed(docs, rows)
    assert sm.remove_repeats(docs.limit(0)).count() == 0


def _check_removed(docs, rows):
    out = sm.remove_repeats(docs).collect()
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(b[i:i + 200] for b in texts for i in range(len(b) - 199))
    want = []
    for (i, *_), b in zip(rows, texts):
        mark = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                mark[k:k + 200] = b"\1" * 200
        spans = sum(1 for k in range(len(b)) if mark[k] and not (k and mark[k - 1]))
        left = bytes(x for x, m in zip(b, mark) if not m)
        want.append((i, len(b), sum(mark), spans, hashlib.sha256(left).hexdigest()))
    assert Counter(tuple(r) for r in out) == Counter(want)


@pytest.mark.parametrize("keys", [300_000, 3])
def test_a_frequent_line_is_spread_over_ranges(make_docs, prose, monkeypatch, keys):
    """A line in every document, some with the same surroundings, and a text longer than a chunk of bytes."""
    monkeypatch.setattr(sm, "BROADCAST_ROWS", keys)
    monkeypatch.setattr(sm, "RUN_SIZE", 100)
    monkeypatch.setattr(sm, "RANGE_SIZE", 60)
    line = "All rights reserved by the authors of the text. "
    around = [prose(500 + i, 40) for i in range(5)]
    rows = [(i, f"{prose(i, 30)} {line}{prose(1000 + i, 30)}") for i in range(400)]
    rows += [(1000 + i, f"{prose(2000 + i, 10)}{around[i % 5][i:]}{line}{around[i % 3][:200 - i]}{prose(3000 + i, 10)}") for i in range(100)]
    rows += [(3000 + i, f"{i} {around[0]}{line}{around[1]}{i}") for i in range(150)]
    long = prose(9, 60_000)
    rows += [(5000, long), (5001, prose(8, 100) + long[250_000:290_000] + prose(7, 100))]
    assert len(long) > 1 << 18
    docs = make_docs(rows)
    _check_removed(docs, rows)
    texts = docs.select(F.col("doc_id").alias("uid"), F.col("text").cast("binary").alias("text"))
    held = sm._shared_bands(texts)[0].groupBy("shift", "reach", "key").count()
    assert held.where("reach > 0").agg(F.max("count")).first()[0] <= 60
    assert held.where(f"reach < {sm._REACH}").count() > 0


def test_checks_compare_shingles_by_sorted_numbers():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 5, 40, 300):
        words = [b"w%d" % i for i in rnd.integers(0, 6, n)]
        ids, hashes = cw.shingle_ids(words), cw.shingle_hashes(words)
        assert len(ids) == len(hashes) and np.array_equal(ids[:, None] == ids, hashes[:, None] == hashes)
        x, y = rnd.integers(0, 50, n).astype(np.uint64), rnd.integers(0, 50, n // 2).astype(np.uint64)
        assert np.array_equal(cw._distinct(x), np.unique(x)) and np.array_equal(cw._among(x, np.sort(y)), np.isin(x, y))
