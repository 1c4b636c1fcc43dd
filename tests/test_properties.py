"""Property tests: Spark operators against plain-Python statements of the same rule.

Each example is one Spark job over many generated rows, so a few examples cover a lot.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blobtally import schemas
from blobtally.functions import bytes_to_long, empty_percent, region_bucket
from blobtally.operators import compact

M = schemas.LONG_MAX
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _trunc_div(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


@SETTINGS
@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1), min_size=1, max_size=200))
def test_bytes_to_long_roundtrip(spark, values):
    rows = [(v.to_bytes(8, "big", signed=True),) for v in values]
    got = [r[0] for r in spark.createDataFrame(rows, "b binary").select(bytes_to_long("b")).collect()]
    assert got == values


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, (1 << 63) - 1), st.integers(0, (1 << 63) - 1)), min_size=1, max_size=200))
def test_empty_percent_truncates_toward_zero(spark, pairs):
    def want(n, r):
        return -1 if n == 0 else _trunc_div((n - r) * 100, n)

    pairs = [(n, r) for n, r in pairs if -(1 << 31) <= want(n, r) < 1 << 31] or [(7, 2)]
    got = [r[0] for r in spark.createDataFrame(pairs, "n bigint, r bigint")
           .select(empty_percent("n", "r")).collect()]
    assert got == [want(n, r) for n, r in pairs]


def test_empty_percent_out_of_range_fails(spark):
    import pytest

    with pytest.raises(Exception, match="empty percent out of range"):
        spark.createDataFrame([(1, 1 << 40)], "n bigint, r bigint").select(empty_percent("n", "r")).collect()


@SETTINGS
@given(st.lists(st.binary(max_size=4), max_size=40, unique=True),
       st.lists(st.binary(max_size=5), min_size=1, max_size=200))
def test_region_bucket_is_greatest_start_key_at_or_below(spark, keys, probes):
    keys = sorted(keys)
    got = [r[0] for r in spark.createDataFrame([(p,) for p in probes], "k binary")
           .select(region_bucket("k", keys)).collect()]
    assert got == [max(sum(1 for k in keys if k <= p) - 1, 0) for p in probes]


@SETTINGS
@given(st.lists(st.sampled_from([0, 1, 3, 40, 99, 100, 101, 250, M]), min_size=1, max_size=300),
       st.integers(1, 90), st.integers(1, 300))
def test_split_packing_is_the_sequential_fold(spark, sizes, width, cap):
    files = list(enumerate(sizes))
    status = spark.createDataFrame([(f, 0, s, "/p", False) for f, s in files], schemas.FILE_STATUS)
    got = {r.file_id: (r.pack_group, r.split_id) for r in compact.plan_splits(status, cap, width).collect()}
    want = {}
    for g in range(len(sizes) // width + 1):
        split, cur = 0, 0
        for f, s in files:
            if f // width != g:
                continue
            want[f] = (g, split)
            cur = min(cur + s, M)
            if cur >= cap:
                split, cur = split + 1, 0
    assert got == want
