"""Embedding whitening with a covariance by polarisation.

Components become integers, so every sum below is exact whatever the order of the rows. Over the
fit list (each distinct integer vector once, n of them with sums S) the centred vector is
y = n*x - S, n times x minus its mean. Only squares are summed: of y_i for every dimension and of
y_i + y_j for every pair; half the difference of the pair's sum and its two dimensions' sums is the
cross term. The assembled covariance goes to ``numpy.linalg.eigh``, and every row is projected on
the leading eigenvectors and scaled to unit variance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import materialise

#: An integer step is 1/SCALE of a component.
SCALE = 256
#: Components returned for a row.
MAX_COMPONENTS = 4
#: Scaled components beyond this have no long; their vectors are left out as non-finite ones are.
MAX_SCALED = float(1 << 62)
#: An eigenvalue below this share of the greatest counts as zero.
MIN_SHARE = 1e-12
#: Limbs of large integers, and rows whose products of limbs are summed at a time.
_LIMB, _ROWS = 21, 4096

RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double"


def integer_vector(v: Column) -> Column:
    """floor(SCALE * component) of every component, computed in double; longs have no minus zero."""
    return F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | ~(F.abs(c.cast("double") * SCALE) < F.lit(MAX_SCALED)))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S, as int64 where every step fits, else as Python integers."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * largest + max((abs(s) for s in sums.tolist()), default=0) < 1 << 62:
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums.astype(object)


def square_sums(y: np.ndarray) -> np.ndarray:
    """Exact column sums of squares, as Python integers.

    Squares that fit are summed as int64; larger numbers are cut into three limbs of 21 bits, whose
    products are summed instead.
    """
    if y.dtype == object:
        return (y * y).sum(axis=0) if len(y) else np.zeros(y.shape[1], object)
    largest = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if largest * largest * max(len(y), 1) < 1 << 63:
        return (y * y).sum(axis=0).astype(object)
    total = np.zeros(y.shape[1], object)
    mask = np.int64((1 << _LIMB) - 1)
    for start in range(0, len(y), _ROWS):
        part = y[start:start + _ROWS]
        limbs = [part & mask, part >> _LIMB & mask, part >> 2 * _LIMB]
        for a in range(3):
            for b in range(3):
                total += (limbs[a] * limbs[b]).sum(axis=0).astype(object) << _LIMB * (a + b)
    return total


def polar_sums(y: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, j, sum of squares of y_i, or of y_i + y_j where i < j) of a block of centred vectors."""
    d = y.shape[1]
    out = [(i, i, q) for i, q in enumerate(square_sums(y))]
    if y.dtype != object and max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))) >= 1 << 62:
        y = y.astype(object)
    for i in range(d - 1):
        out += [(i, i + 1 + k, q) for k, q in enumerate(square_sums(y[:, i + 1:] + y[:, i:i + 1]))]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut by the length of their vectors, each with its matrix."""
    for batch in batches:
        lengths = np.asarray(batch.column(column).value_lengths())
        for d in np.unique(lengths):
            rows = batch.filter(pa.array(lengths == d))
            yield rows, rows.column(column).flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, d)


@dataclass
class Whitening:
    """Fit of the vectors of one length: list size, sums, leading directions and what they explain."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n*x - S of every row, null beyond a long."""
        total = [int(q) for q in square_sums(centred(x, self.n, self.sums).T)]
        return [q if q < 1 << 63 else None for q in total]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the directions, in units of the standard deviation (0 has none: NaN)."""
        off = centred(x, self.n, self.sums).astype(np.float64) / self.n
        scale = np.sqrt(np.where(self.variances > 0, self.variances, np.nan))
        return off @ self.directions / scale


def decompose(n: int, sums: np.ndarray, squares: dict[tuple[int, int], int]) -> Whitening:
    """Covariance from the polarised sums, and its leading eigenvectors by falling eigenvalue.

    A vector's largest entry is made positive. Equal eigenvalues leave their vectors as eigh does.
    """
    d = len(sums)
    cov = np.zeros((d, d))
    for (i, j), q in squares.items():
        cross = q if i == j else (q - squares[i, i] - squares[j, j]) // 2
        cov[i, j] = cov[j, i] = cross / n ** 3  # integers, so rounded once
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:MAX_COMPONENTS]
    values, vectors = values[order], vectors[:, order]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[top, np.arange(len(order))] < 0, -1.0, 1.0)
    trace = sum(squares[i, i] for i in range(d)) / n ** 3
    values = np.where(values > MIN_SHARE * max(values[0], 0.0), values, 0.0)
    return Whitening(n, sums, vectors, values, values / trace if trace else np.full(len(values), np.nan))


def _sums(fit: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """For each length: list size and exact sum of every dimension."""
    place = fit.select(F.size("x").alias("d"), F.posexplode("x").alias("i", "c"))
    rows = place.groupBy("d", "i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).collect()
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in rows:
        out.setdefault(r["d"], (r["n"], np.zeros(r["d"], object)))[1][r["i"]] = int(r["s"])
    return out


def _squares(fit: DataFrame, sums: dict[int, tuple[int, np.ndarray]]) -> dict[int, dict[tuple[int, int], int]]:
    """For each length: the sums of squares over dimensions and pairs of dimensions."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        places: dict[int, tuple] = {}
        for _, x in _blocks(batches, "x"):
            d = x.shape[1]
            i, j, q = zip(*polar_sums(centred(x, *sums[d])))
            places[d] = (i, j)
            total[d] = total.get(d, 0) + np.array(q, object)
        for d, q in total.items():
            i, j = places[d]
            # Decimals are wider than a long; they leave as text.
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(q), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([str(v) for v in q])], names=["d", "i", "j", "q"])

    rows = fit.mapInArrow(partial, "d int, i int, j int, q string") \
        .groupBy("d", "i", "j").agg(F.sum(F.col("q").cast("decimal(38,0)")).alias("q")).collect()
    out: dict[int, dict[tuple[int, int], int]] = {}
    for r in rows:
        out.setdefault(r["d"], {})[r["i"], r["j"]] = int(r["q"])
    return out


def _identity_error(fit: DataFrame, fits: dict[int, Whitening]) -> dict[int, float]:
    """Largest entry of the whitened fit list's covariance minus the identity, for each length."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for _, x in _blocks(batches, "x"):
            w = fits[x.shape[1]].whiten(x)
            total[x.shape[1]] = total.get(x.shape[1], 0.0) + np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        for d, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()),
                                              pa.array(s)], names=["d", "i", "s"])

    rows = fit.mapInArrow(partial, "d int, i int, s double").groupBy("d", "i").agg(F.sum("s").alias("s")).collect()
    out = {}
    for d, f in fits.items():
        k = len(f.variances)
        s = np.zeros(k + k * k)
        for r in rows:
            if r["d"] == d:
                s[r["i"]] = r["s"] / f.n
        real = f.variances > 0
        off = np.abs(s[k:].reshape(k, k) - np.outer(s[:k], s[:k]) - np.eye(k))[np.ix_(real, real)]
        out[d] = float(off.max()) if off.size else None
    return out


def fit_whitening(fit: DataFrame) -> tuple[dict[int, Whitening], dict[int, float]]:
    """Fits and identity errors by vector length, over distinct integer vectors ``fit(x)``.

    The driver holds d * (d + 1) / 2 sums for each length d that occurs.
    """
    sums = _sums(fit)
    squares = _squares(fit, sums)
    fits = {d: decompose(n, s, squares[d]) for d, (n, s) in sums.items()}
    return fits, _identity_error(fit, fits)


def whiten(embeddings: DataFrame) -> DataFrame:
    """Whiten ``embeddings(vec_id long, embedding array)``; other columns are ignored.

    Returns for every remaining row and component (1 to 4, fewer in fewer dimensions): vec_id,
    component, n, deviation (long, sum of squares of n*x - S), whitened, explained (share of the trace)
    and identity_error (double).

    Left out: null vectors, and those with a null, non-finite or unrepresentable (2^54 and more)
    component. Vectors of different lengths are fitted apart; an empty vector has no components
    and so no row. Repeated rows and null ids give rows each, and repeated vectors count once in
    the fit. A direction without variance (fewer distinct vectors than dimensions) has whitened null
    and explained 0 (null if nothing varies). ``deviation`` beyond a long is null. An empty table, or one
    of which nothing remains, gives an empty result.
    """
    v = F.col("embedding")
    rows = embeddings.select("vec_id", "embedding").where(usable(v) & (F.size(v) > 0)).select("vec_id", integer_vector(v).alias("x"))
    fit = materialise(rows.select("x").distinct(), "fit")
    fits, errors = fit_whitening(fit)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _blocks(batches, "x"):
            f = fits[x.shape[1]]
            w, k, n = f.whiten(x), len(f.variances), len(x)
            pick = np.repeat(np.arange(n), k)
            yield pa.RecordBatch.from_arrays([
                rows.column("vec_id").take(pa.array(pick)).cast(pa.int64()), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                pa.array(np.full(n * k, f.n), pa.int64()), pa.array(f.deviation(x), pa.int64()).take(pa.array(pick)),
                pa.array(w.ravel(), mask=np.isnan(w.ravel())), pa.array(np.tile(f.explained, n), mask=np.isnan(np.tile(f.explained, n))),
                pa.array([errors[x.shape[1]]] * (n * k), pa.float64())], names=names)

    schema = f"{RESULT}, identity_error double"
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInArrow(project, schema)
