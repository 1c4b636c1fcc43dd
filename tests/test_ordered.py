"""As-of joins against a binary search, in plans without a broadcast of the keys."""

import bisect
import random

import pytest

from blobtally.operators import cells, ordered


def test_as_of_join_both_ways(spark):
    rnd = random.Random(3)
    keys = [(rnd.randrange(-50, 950), i) for i in range(60)] + [(None, 1000), (400, 2000), (400, 2001)]
    rows = [(rnd.randrange(-100, 1100), i) for i in range(500)] + [(400, i) for i in range(500, 1500)] + [(None, 1), (None, 2)]
    left = spark.createDataFrame(rows, "k bigint, id bigint").repartition(6)
    right = spark.createDataFrame(keys, "at bigint, v bigint").repartition(3)
    down = sorted((k, v) for k, v in keys if k is not None)
    for parts in (1, 4, 13):
        got = {r.id if r.k is not None else -r.id: r.v for r in
               ordered.as_of_join(left, right, "k", "at", ["v"], num_partitions=parts).collect()}
        up = {r.id if r.k is not None else -r.id: (r.at, r.v) for r in
              ordered.as_of_join(left, right, "k", "at", ["at", "v"], forward=True, num_partitions=parts).collect()}
        assert len(got) == len(up) == len(rows)
        for k, i in rows:
            if k is None:
                assert got[-i] is None and up[-i] == (None, None)
                continue
            at = bisect.bisect_right(down, (k, 1 << 40)) - 1
            assert got[i] == (down[at][1] if at >= 0 else None)
            at = bisect.bisect_left(down, (k, -1))
            assert up[i] == (down[at] if at < len(down) else (None, None))


def test_as_of_join_edges(spark):
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, s string")
    none = spark.createDataFrame([], "k2 int, v string")
    assert sorted(map(tuple, ordered.as_of_join(left, none, "k", "k2", ["v"]).collect()), key=str) == \
        sorted([(1, "x", None), (1, "x", None), (2, None, None)], key=str)
    assert ordered.as_of_join(left.limit(0), left.selectExpr("k as k2", "s as v"), "k", "k2", ["v"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        ordered.as_of_join(left, left, "k", "k", ["s"])


def test_one_key_spreads_over_ranges(spark):
    left = spark.range(20_000).selectExpr("5L AS k", "id")
    right = spark.createDataFrame([(1, 10), (9, 11)], "at bigint, v bigint")
    out = ordered.as_of_join(left, right, "k", "at", ["v"], num_partitions=8)
    assert [(r.v, r["count"]) for r in out.groupBy("v").count().collect()] == [(10, 20_000)]
    from blobtally.session import _scratch
    written = spark.read.parquet(next(p for p in reversed(_scratch[spark.sparkContext.applicationId]) if "/as-of-" in p))
    sizes = [r["count"] for r in written.groupBy("_pid").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 5_000


def test_regions_of_a_key_table(spark):
    rnd = random.Random(8)
    keys = sorted({rnd.randbytes(3) for _ in range(3000)})
    probes = [rnd.randbytes(rnd.randrange(0, 5)) for _ in range(2000)] + keys[:50] + [b""]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(probes)], "row_key binary, i int")
    shuffled = keys[:]
    rnd.shuffle(shuffled)
    table = spark.createDataFrame([(k,) for k in shuffled], "start_key binary").repartition(5)
    got = {r.i: r.region for r in cells.add_region(df, table).collect()}
    assert len(got) == len(probes)
    for i, p in enumerate(probes):
        assert got[i] == max(sum(1 for k in keys if k <= p) - 1, 0)
