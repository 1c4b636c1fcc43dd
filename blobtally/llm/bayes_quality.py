"""Quality classifier with hierarchical empirical Bayes priors.

The evidence of a document is the log-likelihood ratio of its words and of its style under two
naive Bayes models, one for quality and one for toxicity. The prior is that of the document's
path (site and language): labelled counts of the path shrink toward the site's posterior, those
of the site toward the global rate. How strongly follows from the spread between the groups, so
sparse groups say little. Posterior log-odds are prior plus evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import BROADCAST_ROWS, materialise, small_side
from blobtally.llm.compact_windows import SHINGLE, shingle_hashes

#: The word models are fitted on at most about this many labelled rows, taken by a hash of the id.
MAX_TRAIN = 200_000
#: Buckets of each of the two word tables; two independent ones keep rare words from borrowing a
#: weight. A word counts if its class has it significantly (in standard deviations) more often,
#: by a factor of e or more, and in this share of its documents.
WORD_BUCKETS, MIN_Z, MIN_WEIGHT, MIN_SUPPORT = 1 << 17, 6.0, 1.0, 0.01
_STYLE_BINS = 24
#: The style of a text shorter than this counts in proportion.
STYLE_BYTES = 400
#: A group's prior strength in pseudo-counts lies in these bounds.
STRENGTH = (2.0, 1000.0)

_KEEP = bytes(c if not 33 <= c < 48 and not 58 <= c < 65 and not 91 <= c < 97 and not 123 <= c < 127 else 32
              for c in range(256))
_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!", b".,;:?'\"()-", b" \t\r", b"\n"], 1):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 9
_N_STYLE = 11


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the distinct words in the first and the second table, and of the style."""
    text = text or b""
    words = text.translate(_KEEP).lower().split()
    h = np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    first = (h & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    second = (h >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS + WORD_BUCKETS
    counts = np.zeros(10)
    for at in range(0, len(text), 1 << 20):
        part = np.frombuffer(text, np.uint8, min(1 << 20, len(text) - at), at)
        counts += np.bincount(_CLASS[part], minlength=10)
    share = np.append(counts[1:] / max(len(text), 1), [len(h) / max(len(words), 1), min(len(words), 400) / 400])
    bins = np.minimum(np.sqrt(share) * (_STYLE_BINS - 1) + 0.5, _STYLE_BINS - 1).astype(np.int64)
    return first, second, 2 * WORD_BUCKETS + np.arange(_N_STYLE) * _STYLE_BINS + bins


_SIZE = 2 * WORD_BUCKETS + _N_STYLE * _STYLE_BINS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, quality, toxic) to (feature, class, documents), summed within the task."""
    total = np.zeros((4, _SIZE), np.int64)
    for batch in batches:
        for text, q, t in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for part in features(text.as_py()):
                total[2 * q + t, np.unique(part)] += 1
    c, f = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(c), pa.array(total[c, f])], names=["feature", "class", "n"])


class Model(NamedTuple):
    """Features with a weight, in order, and their weights under the two models (2 x features)."""

    known: np.ndarray
    weights: np.ndarray

    def of(self, features_: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros((2, len(features_)))
        at = np.minimum(np.searchsorted(self.known, features_), len(self.known) - 1)
        return np.where(self.known[at] == features_, self.weights[:, at], 0.0)


def score(text: bytes | None, model: Model) -> np.ndarray:
    """Log-likelihood ratios of one text under the models of ``fit``."""
    first, second, style = features(text)
    a, b = model.of(first), model.of(second)
    words = np.where(a * b > 0, np.where(np.abs(a) < np.abs(b), a, b), 0.0)
    # The style of a short text is mostly chance.
    return words.sum(axis=1) + model.of(style).sum(axis=1) * min(1.0, len(text or b"") / STYLE_BYTES)


def _family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) to (id, family): the least shingle hash, which near copies mostly share."""
    for batch in batches:
        ids, out = batch.column(0), []
        for text in batch.column(1):
            words = (text.as_py() or b"").lower().split()
            x = shingle_hashes(words, min(SHINGLE, max(len(words), 1)))
            out.append(int(x.min() >> np.uint64(1)) if len(x) else 0)
        yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.int64())], names=["doc_id", "family"])


def _one_of_a_family(labelled: DataFrame) -> DataFrame:
    """``labelled(doc_id, text, ...)`` without the near copies of a document with a lower id."""
    found = labelled.select("doc_id", F.col("text").cast("binary")).mapInArrow(_family, "doc_id long, family long")
    first = materialise(found.groupBy("family").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "families")
    return labelled.join(small_side(first, first.count()), "doc_id", "left_semi")


def fit(labelled: DataFrame) -> Model:
    """Weights of the features for good against bad and toxic against not.

    ``labelled(text, quality, toxic)``. The style's counts reach the driver, and those of words that are
    common enough to count: each is in a share MIN_SUPPORT of a class's documents, so they are at most
    1 / MIN_SUPPORT times a document's mean number of words, however many rows there are.
    """
    by_class = [F.sum(F.when(F.col("class") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in range(4)]
    sums = labelled.select(F.col("text").cast("binary"), F.col("quality").cast("long"), F.col("toxic").cast("long")) \
        .mapInArrow(_count, "feature long, class long, n long").groupBy("feature").agg(*by_class)
    sums = materialise(sums, "features")
    # Every document has one bin of the first style feature.
    docs = sums.where(F.col("feature").between(2 * WORD_BUCKETS, 2 * WORD_BUCKETS + _STYLE_BINS - 1)) \
        .agg(*[F.coalesce(F.sum(f"n{c}"), F.lit(0)) for c in range(4)]).first()
    docs = np.array(docs, float)
    common = (F.col("n0") + F.col("n1") >= F.lit(float(MIN_SUPPORT * (docs[0] + docs[1])))) \
        | (F.col("n1") + F.col("n3") >= F.lit(float(MIN_SUPPORT * (docs[1] + docs[3]))))
    rows = {r["feature"]: r for r in sums.where(common | (F.col("feature") >= 2 * WORD_BUCKETS)).collect()}
    known = np.array(sorted({*rows, *range(2 * WORD_BUCKETS, _SIZE)}), np.int64)
    n = np.array([[rows[f][f"n{c}"] if f in rows else 0 for f in known.tolist()] for c in range(4)], float)
    weights = np.zeros((2, len(known)))
    words = known < 2 * WORD_BUCKETS
    # Words speak one way only, for bad and for toxic: their absence, or words of a language that
    # has more good documents, say nothing. Style speaks both ways, on quality.
    for k, (yes, no, side) in enumerate((([2, 3], [0, 1], -1), ([1, 3], [0, 2], 1))):
        a, b, na, nb = n[yes].sum(axis=0), n[no].sum(axis=0), docs[yes].sum(), docs[no].sum()
        if na and nb:
            # One document more for each class, spread as the feature is in both together.
            share = (a + b + 1) / (na + nb + 2)
            p, q = (a + share) / (na + 1), (b + share) / (nb + 1)
            w = np.log(p) - np.log(q)
            hits, base = (a, na) if side > 0 else (b, nb)
            even = (a + b) * base / (na + nb)
            telling = (hits - even >= MIN_Z * np.sqrt(even + 1)) & (side * w >= MIN_WEIGHT) & (hits >= MIN_SUPPORT * base)
            weights[k] = np.where(telling if side > 0 else telling | ~words, w, 0.0)
            weights[k, ~words] *= side < 0
    used = np.any(weights != 0, axis=0)
    return Model(known[used], weights[:, used])


def _evidence(model: Model, text: str) -> Column:
    @F.pandas_udf("good double, toxic double")
    def of(texts: pd.Series) -> pd.DataFrame:
        out = np.array([score(t, model) for t in texts]).reshape(-1, 2)
        return pd.DataFrame(out, columns=["good", "toxic"])

    return of(F.col(text).cast("binary"))


def _strength(groups: DataFrame, k: str, n: str, rate: str) -> float:
    """Pseudo-counts of the prior by the method of moments, over groups with (k, n, rate)."""
    p = F.col(k) / F.col(n)
    row = groups.where(F.col(n) > 0).agg(
        F.sum(F.col(n) * F.pow(p - F.col(rate), 2)).alias("between"), F.sum(F.col(n) * F.col(rate) * (1 - F.col(rate))).alias("inside"),
        F.sum(n).alias("n"), F.count(F.lit(1)).alias("g")).first()
    if not row["n"] or not row["inside"] or row["g"] < 2:
        return STRENGTH[1]
    variance = row["inside"] / row["n"]
    # Between-group variance beyond what sampling alone gives.
    extra = (row["between"] - row["g"] * variance) / row["n"]
    return STRENGTH[1] if extra <= 0 else float(min(max(variance / extra - 1, STRENGTH[0]), STRENGTH[1]))


def site_priors(counts: DataFrame) -> DataFrame:
    """(source, lang, good_prior, toxic_prior) from ``counts(source, lang, n, good, toxic)``.

    One row for each path; a path's rate shrinks to its site's, the site's to the global one.
    """
    g = counts.agg(F.sum("n"), F.sum("good"), F.sum("toxic")).first()
    total = g[0] or 0
    sites = counts.groupBy("source").agg(*[F.sum(c).alias(f"site_{c}") for c in ("n", "good", "toxic")])
    out = counts.join(sites, counts["source"].eqNullSafe(sites["source"])).drop(sites["source"])
    for i, kind in enumerate(("good", "toxic"), 1):
        rate = ((g[i] or 0) + 1) / (total + 2)
        m = _strength(sites.withColumn("rate", F.lit(rate)), f"site_{kind}", "site_n", "rate")
        out = out.withColumn(f"{kind}_site", (F.col(f"site_{kind}") + m * rate) / (F.col("site_n") + m))
        m = _strength(out, kind, "n", f"{kind}_site")
        out = out.withColumn(f"{kind}_prior", (F.col(kind) + m * F.col(f"{kind}_site")) / (F.col("n") + m))
    return out.select("source", "lang", "good_prior", "toxic_prior")


def classify(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Posterior quality and toxicity of every document.

    Returns the columns ``carry`` (doc_id by default) with evidence and toxic_evidence (log
    ratios), good_prior, toxic_prior, p_good, p_toxic and kept: p_good >= 0.5 and p_toxic < 0.5.
    ``labels(doc_id, quality, toxic)``; of contradicting labels the worse one counts, and a null
    label is none. Null or empty text: evidence of its length only. Null source or lang: a path
    of its own. Without any label every document has even odds and is kept. Repeated rows are
    scored each. Empty in, empty out.
    """
    carry = ["doc_id"] if carry is None else carry
    rows = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), "doc_id", "text", "source", "lang")
    marks = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id") \
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marks = materialise(marks, "labels")
    n = marks.count()
    step = max(1, -(-n // MAX_TRAIN))
    train = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    labelled = rows.join(small_side(train, min(n, MAX_TRAIN)), "doc_id").select("doc_id", "text", "quality", "toxic")
    model = fit(_one_of_a_family(labelled))

    paths = rows.select("doc_id", "source", "lang").join(marks, "doc_id", "left")
    seen = F.col("quality").isNotNull()
    counts = paths.groupBy("source", "lang").agg(
        F.count(F.when(seen, 1)).alias("n"), F.count(F.when(F.col("quality") == 1, 1)).alias("good"),
        F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    counts = materialise(counts, "path_counts")
    priors = materialise(site_priors(counts).withColumnsRenamed({"source": "of", "lang": "in"}), "path_priors")
    scored = rows.withColumn("e", _evidence(model, "text")).drop("text")
    out = scored.join(small_side(priors, priors.count(), BROADCAST_ROWS),
                      scored["source"].eqNullSafe(F.col("of")) & scored["lang"].eqNullSafe(F.col("in")))

    def posterior(prior: str, evidence: Column) -> Column:
        odds = F.log(F.col(prior) / (1 - F.col(prior))) + evidence
        return 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(500.0)), F.lit(-500.0))))

    made = ["evidence", "toxic_evidence", "good_prior", "toxic_prior", "p_good", "p_toxic", "kept"]
    out = out.select("row", F.col("e.good").alias("evidence"), F.col("e.toxic").alias("toxic_evidence"), "good_prior", "toxic_prior",
                     posterior("good_prior", F.col("e.good")).alias("p_good"), posterior("toxic_prior", F.col("e.toxic")).alias("p_toxic"))
    kept = (F.col("p_good") >= 0.5) & (F.col("p_toxic") < 0.5)
    if not n:
        kept = F.lit(True)
    return out.select(*[F.col("row")[c].alias(c) for c in carry if c not in made], *made[:-1], kept.alias("kept"))
