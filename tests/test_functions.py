import pytest
from pyspark.sql import functions as F

from blobtally.functions import (
    bytes_to_long,
    decode_utf8,
    empty_percent,
    is_archived,
    ntz_epoch_millis,
    region_bucket,
    run_timestamp,
)
from blobtally.plans.layout import run_paths, run_timestamp_of


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_bytes_to_long_big_endian_signed(spark):
    rows = [(bytes.fromhex("0000000000000400"),), (bytes.fromhex("FFFFFFFFFFFFFFFE"),),
            (bytes(8),), (None,), (b"",), (bytes.fromhex("7FFFFFFFFFFFFFFF"),),
            (bytes.fromhex("0000000000000400FFFF"),)]
    got = _one(spark, bytes_to_long("b"), "b binary", rows)
    # A longer array is read from its first 8 bytes.
    assert got == [1024, -2, 0, None, None, 9223372036854775807, 1024]


def test_bytes_to_long_short_array_fails(spark):
    with pytest.raises(Exception):
        _one(spark, bytes_to_long("b"), "b binary", [(b"\x01\x02",)])


def test_decode_utf8(spark):
    assert _one(spark, decode_utf8("b"), "b binary", [("ü/κ".encode(),)]) == ["ü/κ"]
    bad = [b"\xff\xfeab", b"\xe2\x82", b"a\xed\xa0\x80b", None]
    assert _one(spark, decode_utf8("b"), "b binary", [(v,) for v in bad]) == \
        [None if v is None else v.decode("utf-8", "replace") for v in bad]


def test_is_archived_needs_slash(spark):
    rows = [("archive/1",), ("archived2/1",), ("archive",), ("photos/archive/1",)]
    assert _one(spark, is_archived("k", "archive"), "k string", rows) == [True, False, False, False]
    with pytest.raises(ValueError):
        is_archived("k", "")


def test_empty_percent_branches(spark):
    rows = [(0, 10), (700, 1200), (7, 2), (100, 100), (100, 0), (3, 1)]
    got = _one(spark, empty_percent("n", "r"), "n bigint, r bigint", rows)
    # zero length -> -1; (700-1200)*100 div 700 = -71 (toward zero); 5*100 div 7 = 71.
    assert got == [-1, -71, 71, 0, 100, 66]


def test_run_timestamp_golden(spark):
    rows = [("2017-09-17/1505661514000/file_status",), ("/b/aggregator/2017-09-17/1505661514000/file_meta/",),
            ("/b/aggregator/2017-09-17/latest/file_status",), ("file_status",), (None,)]
    assert _one(spark, run_timestamp("p"), "p string", rows) == [1505661514000, 1505661514000, None, None, None]
    assert run_timestamp_of("2017-09-17/1505661514000/file_status") == 1505661514000
    with pytest.raises(ValueError):
        run_timestamp_of("x/latest/file_status")


def test_run_paths_layout():
    from datetime import datetime, timezone

    p = run_paths("hdfs://c/blobstore/", datetime(2017, 9, 17, 15, 18, 34, tzinfo=timezone.utc))
    assert p.status == "hdfs://c/blobstore/aggregator/2017-09-17/1505661514000/file_status"
    assert p.meta == "hdfs://c/blobstore/aggregator/2017-09-17/1505661514000/file_meta"
    assert p.status != p.meta
    with pytest.raises(ValueError):
        run_paths("")
    with pytest.raises(ValueError):
        run_paths("/no/slash")


def test_ntz_epoch_millis(spark):
    df = spark.sql("select timestamp_ntz'2017-09-17 15:18:34.5' as t")
    assert df.select(ntz_epoch_millis("t")).first()[0] == 1505661514500


def test_region_bucket(spark):
    keys = [b"", b"\x10", b"\x80", b"\x80\x01"]
    rows = [(b"",), (b"\x05",), (b"\x10",), (b"\x7f\xff",), (b"\x80",), (b"\x80\x00",), (b"\x80\x01",), (b"\xff",)]
    assert _one(spark, region_bucket("k", keys), "k binary", rows) == [0, 0, 1, 1, 2, 2, 3, 3]
    # Row keys below the first start key fall into region 0; no keys means one region.
    assert _one(spark, region_bucket("k", [b"m", b"t"]), "k binary", [(b"a",), (b"m",), (b"z",)]) == [0, 0, 1]
    assert _one(spark, region_bucket("k", []), "k binary", [(b"a",)]) == [0]
    with pytest.raises(ValueError):
        region_bucket("k", [b"b", b"a"])


def test_region_bucket_matches_linear_count(spark):
    import random

    rnd = random.Random(3)
    keys = sorted({bytes(rnd.randrange(256) for _ in range(rnd.randrange(1, 4))) for _ in range(37)})
    probes = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(0, 4))) for _ in range(300)]
    got = _one(spark, region_bucket("k", keys), "k binary", [(p,) for p in probes])
    want = [max(sum(1 for k in keys if k <= p) - 1, 0) for p in probes]
    assert got == want


def test_scale_conf():
    from blobtally.session import scale_conf

    conf = scale_conf(100 * (1 << 40))  # 100 TiB shuffled
    assert conf["spark.sql.shuffle.partitions"] == "409600"
    assert scale_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"  # floor
    assert scale_conf(10 * (1 << 40))["spark.sql.shuffle.partitions"] == "40960"


def test_cell_label_and_millis_instant(spark):
    from blobtally.functions import cell_label, millis_instant

    df = spark.createDataFrame([(b"r1", b"f", b"q", 1505661514000), (b"r\xff", b"", b"q:2", None), (None, b"f", b"q", -1)],
                               "r binary, f binary, q binary, ms bigint")
    got = [tuple(x) for x in df.select(cell_label("r", "f", "q"), F.unix_millis(millis_instant("ms"))).collect()]
    assert got == [("r1:f:q", 1505661514000), ("r\ufffd::q:2", None), (None, -1)]
