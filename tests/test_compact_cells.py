"""Split packing, relocation, marking, and key-value cells."""

import glob
import os
import random
import shutil

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from blobtally import schemas
from blobtally.operators import cells, compact, refs, status
from blobtally.sources import read_cell_store, read_manifest

CAP = 100
M = schemas.LONG_MAX


def status_df(spark, sizes):
    rows = [(fid, 0, size, f"/f{fid}", False) for fid, size in sizes]
    return spark.createDataFrame(rows, schemas.FILE_STATUS)


def sequential_fold(sizes, cap):
    out, split, cur = {}, 0, 0
    for fid, size in sizes:
        out[fid] = split
        cur = min(cur + size, M)
        if cur >= cap:
            split, cur = split + 1, 0
    return out


def test_plan_splits_edges(spark):
    # One group: 60+40 reaches the cap exactly and closes; a file over the cap sits alone;
    # the all-archived sentinel closes its split instead of wrapping negative.
    sizes = [(1, 60), (2, 40), (3, 250), (4, 10), (5, M), (6, 5), (7, 0)]
    got = {r.file_id: r.split_id for r in compact.plan_splits(status_df(spark, sizes), CAP, 1000).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 2, 5: 2, 6: 3, 7: 3}
    summary = {(r.split_id): (r.size, r.n_files) for r in
               compact.split_summary(compact.plan_splits(status_df(spark, sizes), CAP, 1000)).collect()}
    assert summary == {0: (100, 2), 1: (250, 1), 2: (M, 2), 3: (5, 2)}
    no_archived = compact.plan_splits(status_df(spark, sizes), CAP, 1, include_archived=False)
    assert 5 not in {r.file_id for r in no_archived.collect()}


def test_plan_splits_empty_input(spark):
    assert compact.plan_splits(status_df(spark, [(1, 5)]).limit(0), CAP).count() == 0


def test_plan_splits_matches_sequential_fold_per_group(spark):
    rnd = random.Random(11)
    sizes = [(fid, rnd.choice([0, 1, 7, 30, 60, 99, 100, 130, M])) for fid in rnd.sample(range(10_000), 700)]
    assigned = compact.plan_splits(status_df(spark, sizes), CAP, 2000)
    got = {r.file_id: (r.pack_group, r.split_id) for r in assigned.collect()}
    assert len(got) == len(sizes)                       # every file lands in exactly one split
    for g in range(5):
        group = sorted((fid, s) for fid, s in sizes if fid // 2000 == g)
        want = sequential_fold(group, CAP)
        assert {fid: got[fid] for fid, _ in group} == {fid: (g, s) for fid, s in want.items()}
    # Every split but the last of its group reaches the cap.
    summ = compact.split_summary(assigned)
    last = summ.groupBy("pack_group").agg(F.max("split_id").alias("last"))
    short = summ.join(last, "pack_group").filter((F.col("split_id") < F.col("last")) & (F.col("size") < CAP))
    assert short.count() == 0


def test_a_new_file_changes_its_own_group_alone(spark):
    sizes = [(i, 30) for i in range(0, 4000, 8)]  # strided ids spread over the groups
    before = {r.file_id: (r.pack_group, r.split_id) for r in compact.plan_splits(status_df(spark, sizes), CAP, 400).collect()}
    assert {g for g, _ in before.values()} == set(range(10))
    more = compact.plan_splits(status_df(spark, sizes + [(1201, 30), (9000, 30)]), CAP, 400).collect()
    after = {r.file_id: (r.pack_group, r.split_id) for r in more}
    assert {f: v for f, v in after.items() if v[0] not in (3, 22)} == {f: v for f, v in before.items() if v[0] != 3}


def test_negative_ids_and_null_sizes(spark):
    import pytest
    got = {r.file_id: r.pack_group for r in compact.plan_splits(status_df(spark, [(-1, 5), (-10, 5), (-11, 5), (9, 5)]), CAP, 10).collect()}
    assert got == {-1: -1, -10: -1, -11: -2, 9: 0}
    missing = spark.createDataFrame([(1, None)], "file_id bigint, remainSize bigint")
    with pytest.raises(Exception, match="no remainSize for file 1"):
        compact.plan_splits(missing, CAP).collect()


def test_merge_tails_repacks_open_splits_in_group_order(spark):
    sizes = [(0, 70), (1, 50), (2, 40), (10, 30), (11, 20), (12, 90)]  # groups of ten ids
    merged = compact.plan_splits(status_df(spark, sizes), CAP, 10, merge_tails=True).collect()
    got = {r.file_id: (r.pack_group, r.split_id) for r in merged}
    # Group 0: 70+50 closes (split 0); 40 open tail. Group 1: 30+20+90 closes. Only group 0 has
    # an open tail (file 2), packed again into the tail group -1.
    assert got == {0: (0, 0), 1: (0, 0), 10: (1, 0), 11: (1, 0), 12: (1, 0), 2: (-1, 0)}
    sizes2 = [(0, 10), (1, 30), (10, 20), (11, 50), (20, 5), (30, 0)]
    got2 = {r.file_id: (r.pack_group, r.split_id) for r in
            compact.plan_splits(status_df(spark, sizes2), CAP, 10, merge_tails=True, groups_per_tail=2).collect()}
    # All tails are open: two groups each share a tail group, 10+30+20+50 closes at file 11.
    assert got2 == {0: (-1, 0), 1: (-1, 0), 10: (-1, 0), 11: (-1, 0), 20: (-2, 0), 30: (-2, 0)}


def test_relocation_plan_has_no_gap_or_overlap(spark, fx):
    r = refs.object_refs(fx.objects_raw)
    st = status.file_status(r, fx.blob_index, fx.file_index, fx.file_lengths, "archive")
    meta = status.file_meta(r, fx.blob_index, st, "archive")
    assigned = compact.plan_splits(st, 4194304, 16)
    plan = compact.plan_relocation(assigned, meta).collect()
    # Cutting files into many small chunks must give the same plan.
    small_chunks = compact.plan_relocation(assigned, meta, chunk_bytes=5000).collect()
    assert sorted(map(tuple, small_chunks)) == sorted(map(tuple, plan))
    by_split = {}
    for row in plan:
        by_split.setdefault((row.pack_group, row.split_id), []).append(row)
    for rows in by_split.values():
        rows.sort(key=lambda x: x.new_start)
        pos = 0
        for row in rows:
            assert row.new_start == pos
            pos += row.length
    # Every live blob of a planned file is placed once.
    assert len(plan) == meta.select("meatRowKey").distinct().count()


def test_mark_deleted(spark):
    st = spark.createDataFrame([(1, 95, 5, "/a", False), (2, 10, 90, "/b", False), (3, -1, M, "/c", False)],
                               schemas.FILE_STATUS)
    got = {r.file_id: r.deleted for r in compact.mark_deleted(st, min_empty_percent=90).collect()}
    assert got == {1: True, 2: False, 3: False}
    got = {r.file_id: r.deleted for r in compact.mark_deleted(st, F.col("remainSize") == M).collect()}
    assert got == {1: False, 2: False, 3: True}


def _records(spark):
    return spark.createDataFrame(
        [(b"\x80a", "x", 1), (b"\x01b", None, 2), (b"\x80a", "y", None), (b"\xff", "z", 3)],
        "row_key binary, name string, n int")


def test_to_cells_drops_nulls_and_encodes(spark):
    c = cells.to_cells(_records(spark), "row_key", "f", {"name": "name", "n": "n"})
    got = sorted((bytes(r.row_key), bytes(r.qualifier), bytes(r.value)) for r in c.collect())
    assert got == [(b"\x01b", b"n", b"2"), (b"\x80a", b"n", b"1"), (b"\x80a", b"name", b"x"),
                   (b"\x80a", b"name", b"y"), (b"\xff", b"n", b"3"), (b"\xff", b"name", b"z")]


def test_flat_map_cells(spark):
    def fn(rec):
        if rec["name"] is not None:
            yield (bytes(rec["row_key"]), b"f", b"name", rec["name"].encode())

    c = cells.flat_map_cells(_records(spark), fn)
    assert sorted(bytes(r.value) for r in c.collect()) == [b"x", b"y", b"z"]


def test_sort_is_unsigned_bytewise_and_positions_are_dense(spark):
    c = cells.to_cells(_records(spark), "row_key", "f", {"name": "name", "n": "n"}).repartition(3)
    ordered = [(bytes(r.row_key), bytes(r.qualifier)) for r in cells.sort_cells(c).collect()]
    assert ordered == sorted(ordered)
    assert ordered[0][0] == b"\x01b" and ordered[-1][0] == b"\xff"
    pos = sorted((r.pos, bytes(r.row_key), bytes(r.family), bytes(r.qualifier)) for r in
                 cells.with_sort_position(c, cells.CELL_ORDER).collect())
    assert [p[0] for p in pos] == list(range(1, 7))
    assert [p[1:] for p in pos] == sorted(p[1:] for p in pos)


def test_partition_by_region_is_exact(spark):
    rnd = random.Random(2)
    rows = [(bytes(rnd.randrange(256) for _ in range(3)), "v") for _ in range(400)]
    df = spark.createDataFrame(rows, "row_key binary, name string")
    c = cells.to_cells(df, "row_key", "f", {"name": "name"})
    keys = [b"", b"\x40", b"\x80", b"\xc0"]
    parted = cells.partition_by_region(c, keys)
    assert parted.rdd.getNumPartitions() == 4
    tagged = cells.add_region(parted, keys).withColumn("pid", F.spark_partition_id())
    assert tagged.filter(F.col("pid") != F.col("region")).count() == 0


def test_bulk_load_files_sorted_and_inside_one_region(spark, tmp_dir):
    rnd = random.Random(4)
    # A hot region: most keys start with 0x90.
    rows = [((b"\x90" if i % 3 else bytes([rnd.randrange(256)])) + i.to_bytes(4, "big"), f"v{i}")
            for i in range(3000)]
    c = cells.to_cells(spark.createDataFrame(rows, "row_key binary, name string"), "row_key", "f", {"name": "name"})
    keys = [b"", b"\x40", b"\x80", b"\xc0"]
    out = cells.bulk_load_cells(c, keys, os.path.join(tmp_dir, "staging"), num_files=8)
    manifest = {r.file: r for r in read_manifest(spark, out).collect()}
    total = 0
    hot_files = 0
    for region_dir in glob.glob(os.path.join(out, "data", "region=*")):
        region = int(region_dir.rsplit("=", 1)[1])
        lo = keys[region]
        hi = keys[region + 1] if region + 1 < len(keys) else None
        files = glob.glob(os.path.join(region_dir, "*.parquet"))
        if region == 2:
            hot_files = len(files)
        for f in files:
            t = pq.read_table(f).to_pydict()
            ks = list(zip(t["row_key"], t["family"], t["qualifier"]))
            entry = manifest[os.path.basename(f)]
            assert (entry.region, entry.n_cells) == (region, len(ks))
            assert tuple(bytes(entry[f"first_{c}"]) for c in cells.CELL_ORDER) == ks[0]
            assert tuple(bytes(entry[f"last_{c}"]) for c in cells.CELL_ORDER) == ks[-1]
            assert ks == sorted(ks)
            assert all(k[0] >= lo and (hi is None or k[0] < hi) for k in ks)
            total += len(ks)
    assert total == 3000
    assert hot_files > 1  # the hot region is split over several files
    # Files without a manifest entry (an attempt that was not accepted) are not read; a new load replaces the old one.
    shutil.copy(f, os.path.join(os.path.dirname(f), "stray.parquet"))
    assert read_cell_store(spark, out).count() == 3000
    cells.bulk_load_cells(c.limit(10), keys, out)
    assert read_cell_store(spark, out).count() == 10


def test_write_cells_roundtrip(spark, tmp_dir):
    c = cells.to_cells(_records(spark), "row_key", "f", {"name": "name"})
    p = cells.write_cells(c, os.path.join(tmp_dir, "cells"))
    assert spark.read.parquet(p).count() == 3


def test_write_cells_with_external_writer(spark, tmp_dir):
    root = tmp_dir

    def open_writer():
        # A stand-in key-value store: each writer appends its batches to its own file.
        import os as _os
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as _pq

        path = _os.path.join(root, uuid.uuid4().hex + ".arrow")

        class Writer:
            def __init__(self):
                self.batches = []

            def write(self, batch):
                self.batches.append(batch)

            def close(self):
                if self.batches:
                    _pq.write_table(pa.Table.from_batches(self.batches), path)

        return Writer()

    c = cells.to_cells(_records(spark), "row_key", "f", {"name": "name", "n": "n"}).repartition(3)
    n = cells.write_cells_with(c, open_writer)
    assert n == 6
    written = [r for f in glob.glob(os.path.join(tmp_dir, "*.arrow")) for r in pq.read_table(f).to_pylist()]
    assert sorted((r["row_key"], r["qualifier"]) for r in written) == \
        sorted((bytes(r.row_key), bytes(r.qualifier)) for r in c.collect())


def test_merge_tails_orders_large_file_ids_by_group(spark):
    n = 1 << 41
    sizes = [(2, 100), (1, 100), (n, 100), (n + 1, 10), (9223372036854775001, 5)]
    got = {r.file_id: (r.pack_group, r.split_id) for r in
           compact.plan_splits(status_df(spark, sizes), 250, n, merge_tails=True, groups_per_tail=1 << 40).collect()}
    # Group 0 tail (1, 2), then group 1 (n, n + 1): 300 closes at file n; the last file is open.
    assert got == {1: (-1, 0), 2: (-1, 0), n: (-1, 0), n + 1: (-1, 1), 9223372036854775001: (-1, 1)}


def test_mark_deleted_keeps_existing_marks(spark):
    st = spark.createDataFrame([(1, 50, 5, "/a", True), (2, 95, 5, "/b", False)], schemas.FILE_STATUS)
    got = {r.file_id: r.deleted for r in compact.mark_deleted(st, min_empty_percent=90).collect()}
    assert got == {1: True, 2: True}


def test_relocation_keeps_blobs_without_start(spark):
    meta = spark.createDataFrame([("7_a", "o1", None, 5), ("7_b", "o2", 0, 10), ("7_c", "o3", 10, 3)],
                                 schemas.FILE_META)
    assigned = spark.createDataFrame([(7, 0, 0, 18)], schemas.SPLIT_ASSIGNMENT)
    got = sorted((r.blob_id, r.new_start) for r in compact.plan_relocation(assigned, meta).collect())
    assert got == [("a", 0), ("b", 5), ("c", 15)]


def test_custom_cells_keep_integers_and_nulls(spark):
    df = spark.createDataFrame([(1, 9007199254740993), (2, None), (3, 5)], "id bigint, n bigint")

    def cells_of(r):
        yield str(r["id"]).encode(), b"f", b"n", None if r["n"] is None else str(r["n"]).encode()

    got = {bytes(r.row_key): bytes(r.value) for r in cell_ops_flat(df, cells_of).collect()}
    assert got == {b"1": b"9007199254740993", b"3": b"5"}


def cell_ops_flat(df, fn):
    from blobtally.operators import cells

    return cells.flat_map_cells(df, fn)


def test_null_row_key_has_no_region(spark):
    import pytest

    df = spark.createDataFrame([(None,), (b"\x01\x00",)], "row_key binary")
    for n in (0, 3, 512, 513, 2000):
        keys = [bytes([i // 256, i % 256]) for i in range(n)]
        table = spark.createDataFrame([(k,) for k in keys], "start_key binary")
        for given in (keys, table):
            got = [r.region for r in cells.add_region(df, given).collect()]
            assert sorted(got, key=lambda x: (x is not None, x)) == [None, max(min(256, n - 1), 0)]
    with pytest.raises(ValueError, match="start_key"):
        cells.add_region(df, [b""] * 5000)
