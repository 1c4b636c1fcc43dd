"""Order MinHash: the sketch against its definition, the edited texts against a loop over all documents."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from blobtally.llm import order_minhash as om
from blobtally.llm.common import mix64


def slow_sketch(text):
    """The definition, element by element."""
    width = min(om.K, len(text))
    grams = [text[i:i + width] for i in range(len(text) - width + 1)] if width else []
    if not grams:
        return [0] * om.COMPONENTS
    full = 1 << 64
    mixed = lambda x: int(mix64(np.array([x % full], np.uint64))[0])
    code = {}
    for g in grams:
        x = width
        for c in g:
            x = (x * int(om._PRIME) + ord(c)) % full
        code[g] = mixed(x)
    seen, rows = {}, []
    for i, g in enumerate(grams):
        n = seen[g] = seen.get(g, -1) + 1
        rows.append(((code[g] + n * int(om._STEP)) % full % (1 << 32), i, code[g]))
    out = []
    for j, a in enumerate(om._FACTORS):
        best = sorted(rows, key=lambda r: r[0] * int(a) % (1 << 32))[:om.TUPLE]
        x = j + 1
        for _, _, g in sorted(best, key=lambda r: r[1]):
            x = mixed(x * int(om._PRIME) + g)
        out.append(x >> 32)
    return out


def test_sketch_is_the_definition(prose):
    texts = ["", "a", "abcde", "abcdef", "abcabcabcabcabcabc", "x" * 300, "éü" * 9, prose(1, 60), prose(2, 900)]
    for t in texts:
        assert om.sketch(t).tolist() == slow_sketch(t), t[:20]


def test_order_and_edits_lower_the_likeness(prose):
    rng = random.Random(3)
    words = prose(5, 600).split()
    base = " ".join(words)
    prints = []
    for share in (0.0, 0.02, 0.1, 0.4):
        new = [("zq" + w[::-1]) if rng.random() < share else w for w in words]
        prints.append(om.likeness(om.sketch(base), om.sketch(" ".join(new))))
    assert prints[0] == 1.0 and prints == sorted(prints, reverse=True) and prints[-1] < 0.2
    blocks = [words[i:i + 20] for i in range(0, 600, 20)]
    rng.shuffle(blocks)
    shuffled = " ".join(w for b in blocks for w in b)  # nearly the same k-mers in another order
    assert om.likeness(om.sketch(base), om.sketch(shuffled)) < 0.8


def slow_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for at, (i, text) in enumerate(order):
        own, following = text or "", order[(at + 1) % len(order)][1] or ""
        q = len(own) // 4
        new = own[:len(own) - q] + following[:q]
        a, b, c = (np.array(om.sketch(x)) for x in (own, new, following))
        out.append((i, len(own), hashlib.sha256(new.encode()).hexdigest(), om.fingerprint(a), om.fingerprint(b),
                    float(np.mean(a == b)), float(np.mean(a == c))))
    return out


def test_documents_against_a_loop(make_docs, prose):
    rows = [(i * 8 % 301, prose(i % 90, 3 + i % 60)) for i in range(300)]  # ids all differ
    rows += [(400, None), (401, ""), (402, ""), (403, "éü中"), (404, "𝒳" * 50), (405, " \t\n"), (None, "no id"), (406, "w" * 60_000)]
    docs = make_docs(rows, extra=["piece", "h", "last", "n", "size"]).repartition(7)
    got = om.edited_fingerprints(docs, n_ranges=9)
    assert got.columns == [c.split()[0] for c in om.RESULT.split(", ")]
    got = [tuple(r) for r in got.collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(slow_rows(rows), key=key)


def test_repeated_rows(make_docs, prose):
    """Equal rows follow each other, and the last of them is followed by the next document."""
    a, b, c = prose(1, 40), prose(2, 40), prose(3, 40)
    rows = [(1, a)] * 400 + [(2, b), (3, c), (3, c)]
    got = [tuple(r) for r in om.edited_fingerprints(make_docs(rows).repartition(5), n_ranges=4).collect()]
    assert sorted(got) == sorted(slow_rows(rows))
    assert sum(r[6] == 1.0 for r in got) == 400  # 399 of the first and one of the last
    one = om.edited_fingerprints(make_docs([(9, a)])).collect()
    assert len(one) == 1 and one[0]["near_edited"] < 1.0 and one[0]["near_next"] == 1.0
    assert om.edited_fingerprints(make_docs([])).count() == 0


def test_ties_of_an_id(make_docs):
    """Different texts under one id (here a third of all rows) are spread over the ranges."""
    rows = [(5, f"text number {i} of one id") for i in range(200)] + [(i + 10, f"text {i}") for i in range(400)]
    out = om.edited_fingerprints(make_docs(rows), n_ranges=12)
    got = out.collect()
    assert len(got) == 600 and len({r["fingerprint"] for r in got if r["doc_id"] == 5}) == 200
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 12 and max(sizes) < 4 * 600 / 12
