"""Distribution divergence: distances against plain Python, junk in every language, clean documents kept."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blobtally.llm import quality_rules as qr

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def js(p, q):
    n, m = sum(p), sum(q)
    if not n or not m:
        return None
    out = 0.0
    for x, y in zip(p, q):
        x, y = x / n, y / m
        mid = (x + y) / 2
        out += (x * math.log2(x / mid) if x else 0) / 2 + (y * math.log2(y / mid) if y else 0) / 2
    return math.sqrt(max(out, 0))


def classes(text):
    kinds = [r"[\x20\x09-\x0D]", qr.UPPER, qr.DIGIT, qr.PUNCT, qr.OPERATOR, qr.CONTROL, r"[^\x00-\x7F]", qr.SYMBOLS]
    n = [len(re.findall(k, text)) for k in kinds]
    return [*n, len(text) - sum(n)]


def slow(rows):
    """{doc_id: (class, word, coverage distance)} for rows (doc_id, text, lang)."""
    counts, total = {}, Counter()
    for _, text, lang in rows:
        for w in WORDS.findall(text or ""):
            counts.setdefault(lang, Counter())[w if len(w) <= qr.SHORT else None] += 1
    every = sum(counts.values(), Counter())

    def top(c):
        return sorted((w for w in c if w is not None), key=lambda w: (-c[w], w))[:qr.N_COMMON]

    common = {g: top(c) for g, c in counts.items() if g is not None and sum(c.values()) >= qr.MIN_REFERENCE_WORDS}
    hist, own = {}, {}
    for i, text, lang in rows:
        words = WORDS.findall(text or "")
        c = Counter(words)
        seen = [c[w] for w in common.get(lang, top(every))]
        hist[i] = (classes(text or ""), [*seen, len(words) - sum(seen)], len(words))
        total[lang] += len(words)

    def mean(kind, ids, least):
        use = [h[kind] for h in (hist[i] for i in ids) if (sum(h[0]) if kind == 0 else h[2]) >= least and sum(h[kind])]
        return [sum(x[k] / sum(x) for x in use) for k in range(len(use[0]))] if use else []

    all_classes = mean(0, hist, qr.MIN_CLASS_CHARS)
    token = [every[w] for w in top(every)]
    fallback = [*token, sum(every.values()) - sum(token)]
    for i, text, lang in rows:
        ref = ([j for j, _, g in rows if g == lang] if lang is not None and total[lang] >= qr.MIN_REFERENCE_WORDS else None)
        c, w, n = hist[i]
        rc = mean(0, ref, qr.MIN_CLASS_CHARS) if ref else all_classes
        rw = mean(1, ref, qr.MIN_COMMON_WORDS) if ref else fallback
        own[i] = (js(c, rc) if sum(c) >= qr.MIN_CLASS_CHARS else None, *(
            (js(w, rw), js([sum(w[:-1]), w[-1]], [sum(rw[:-1]), rw[-1]])) if n >= qr.MIN_COMMON_WORDS else (None, None)))
    return own


def test_distances_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame([(90_001, "plain words of no known language " * 20, None, "s", 0), (90_002, "one two three four " * 30, "xx", "s", 0),
                                  (90_003, None, "en", "s", 0), (90_004, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(more)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    want = slow(rows)
    for r in qr.quality_rules(docs, carry=["doc_id"]).collect():
        got = (r["class_distance"], r["word_distance"], r["coverage_distance"])
        for x, y in zip(got, want[r["doc_id"]]):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9), (r["doc_id"], got, want[r["doc_id"]])


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(1)
    kinds = ["{}[]=/@_~^+`", "{}\x01\x02\x07", "bcdfghjklmnpqrstvwxz", "中文字符漢字仮名語本"]
    langs = [r[0] for r in docs.select("lang").distinct().collect()] + [None, "xx"]
    junk = [(10_000_000 + len(langs) * i + j, " ".join("".join(rng.choice(k) for _ in range(rng.randint(2, 8))) for _ in range(300)), g, "junk", 0)
            for i, k in enumerate(kinds) for j, g in enumerate(langs)]
    return qr.quality_rules(docs.unionByName(spark.createDataFrame(junk, docs.schema)), carry=["doc_id", "source", "lang"]).collect()


def test_junk_goes_in_every_language(judged):
    junk = [r for r in judged if r["doc_id"] >= 10_000_000]
    assert len(junk) >= 16 and not any(r["base_failed"] for r in junk)
    assert [(r["doc_id"], r["lang"]) for r in junk if r["kept"]] == []


def test_clean_documents_stay(spark, judged):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    good = {r["doc_id"] for r in labels.where("q = 1 AND t = 0").collect()}
    clean = [r for r in judged if r["doc_id"] in good and not r["base_failed"]]
    assert len(clean) > 200 and sum(r["kept"] for r in clean) >= 0.99 * len(clean)
