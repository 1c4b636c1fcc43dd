"""Polarisation covariance: exact sums against Python integers, components against a direct computation."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from blobtally.llm import polar_whitening as pw

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("n", T.StringType()), T.StructField("component", T.StringType())])


@pytest.mark.parametrize("bits", [3, 20, 31, 45, 62])
def test_square_sums_are_exact(bits):
    rng = np.random.default_rng(bits)
    y = rng.integers(-(1 << bits), 1 << bits, (200, 5))
    want = [sum(int(v) ** 2 for v in y[:, j]) for j in range(5)]
    assert pw.square_sums(y).tolist() == want
    sums = {(i, j): q for i, j, q in pw.polar_sums(y)}
    for i in range(5):
        for j in range(i + 1, 5):
            cross = (sums[i, j] - sums[i, i] - sums[j, j]) // 2
            assert cross == sum(int(a) * int(b) for a, b in y[:, [i, j]])
    assert pw.square_sums(np.zeros((0, 2), np.int64)).tolist() == [0, 0]


def direct(vectors):
    """x, fit list, exact deviations and the covariance from exact fractions."""
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    sums = [sum(r[i] for r in fit) for i in range(d)]
    cov = np.array([[float(sum((Fraction(r[i]) - Fraction(sums[i], n)) * (Fraction(r[j]) - Fraction(sums[j], n)) for r in fit) / n)
                     for j in range(d)] for i in range(d)])
    dev = [sum((n * v - s) ** 2 for v, s in zip(r, sums)) for r in x]
    return np.array(x), n, np.array(sums), cov, dev


def check(rows, vectors):
    x, n, sums, cov, dev = direct(vectors)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(4, len(e))
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert all(sorted(b) == list(range(1, k + 1)) for b in by.values())
    for c in range(k):
        got = np.array([by[i][c + 1]["whitened"] for i in range(len(x))])
        want = (x - sums / n) @ v[:, c] / math.sqrt(e[c])
        assert np.allclose(got, want, atol=1e-9) or np.allclose(got, -want, atol=1e-9)
    for i, b in by.items():
        assert all(r["n"] == n and r["deviation"] == dev[i] for r in b.values())
        assert np.allclose([b[c + 1]["explained"] for c in range(k)], e[:k] / np.trace(cov), rtol=1e-9)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_whitening_against_fractions(spark):
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(7, 7)) * np.array([5, 3, 2, 1, 0.5, 0.2, 0.1])[:, None]
    v = (rng.normal(size=(90, 7)) @ mix * 0.2 + 0.3).astype(np.float32)
    v = np.concatenate([v, v[:40], v[:1].repeat(60, 0), -v[:3]])  # repeated vectors, one of them hot
    bad = [(9000, None), (9001, [float("nan")] * 7), (9002, [1.0, None] * 3 + [1.0]), (9003, [float("inf")] + [0.0] * 6),
           (9004, [3e38] + [0.0] * 6), (9005, [])]
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame([(*r, "mine", "mine") for r in rows + bad], SCHEMA).repartition(5)
    got = pw.whiten(df).collect()
    assert {r["vec_id"] for r in got} == set(range(len(v))) and len(got) == 4 * len(v)
    check(got, v)


def test_given_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    got = pw.whiten(table).collect()
    assert len(got) == 4 * len(rows)
    check(got, [r["embedding"] for r in rows])


def test_degenerate_tables(spark):
    def run(rows):
        return pw.whiten(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)).collect()

    assert run([]) == [] and run([(1, None), (2, [float("nan")])]) == []
    one = run([(1, [0.5, -0.0]), (None, [0.5, 0.0]), (1, [0.5, 0.0])])
    assert len(one) == 6 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None
                                 and r["identity_error"] is None for r in one)
    line = run([(i, [i * 0.5, i * 0.5, 1.0]) for i in range(5)])  # one direction with variance
    by = {r["component"]: r for r in line if r["vec_id"] == 4}
    assert by[1]["whitened"] == pytest.approx(math.sqrt(2), abs=1e-9) and by[1]["explained"] == pytest.approx(1.0)
    assert by[2]["whitened"] is None and by[2]["explained"] == 0.0 and by[1]["identity_error"] < 1e-9
    mixed = run([(1, [1.0, 2.0]), (2, [3.0, 5.0]), (3, [1.0]), (4, [2.0]), (5, [4.0])])  # fitted apart by length
    assert {(r["vec_id"], r["n"]) for r in mixed} == {(1, 2), (2, 2), (3, 3), (4, 3), (5, 3)}
    # Large components: sums beyond a long stay exact, a deviation beyond it is null.
    wide = run([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 2.0])])
    assert all(r["deviation"] is None for r in wide if r["vec_id"] != 3) and wide[0]["identity_error"] < 1e-4
