"""The whole-table split fold against the sequential fold, for every way of dealing the files."""

import random

import numpy as np
import pytest

from blobtally import schemas
from blobtally.operators import table_splits as ts

M = schemas.LONG_MAX


def status_df(spark, sizes):
    return spark.createDataFrame([(fid, 0, size, f"/f{fid}", False) for fid, size in sizes], schemas.FILE_STATUS)


def fold(sizes, cap):
    out, split, current = {}, 0, 0
    for fid, size in sorted(sizes):
        out[fid] = split
        current += size
        if current >= cap:
            split, current = split + 1, 0
    return out


def test_entry_classes_follow_the_chain():
    rnd = random.Random(5)
    for _ in range(200):
        sizes = np.array([rnd.choice([0, 0, 1, 3, 10, 25, 100]) for _ in range(rnd.randint(1, 40))])
        ends, leaves, starts = ts.entry_classes(sizes, 25)
        before = np.cumsum(sizes) - sizes
        at = 0
        for k in range(len(sizes)):
            while ends[at] < k:
                at += 1
            i, n = k, 1
            while (j := int(np.searchsorted(before, before[i] + 25, side="left"))) < len(sizes):
                i, n = j, n + 1
            assert (leaves[at], starts[at]) == (before[i] + 25, n)


@pytest.mark.parametrize("choice", [[0, 1, 7, 30, 60, 99, 100, 130, M], [1], [0, 0, 0, 2000]])
def test_equals_the_sequential_fold(spark, choice):
    rnd = random.Random(sum(choice) % 97)
    sizes = [(fid, rnd.choice(choice)) for fid in rnd.sample(range(-2000, 6000), 500)]
    want = fold(sizes, 100)
    for width in (60, 100_000):
        got = {r.file_id: r.split_id for r in ts.plan_table_splits(status_df(spark, sizes).repartition(5), 100, width).collect()}
        assert got == want, width


def test_empty_and_bad_input(spark):
    assert ts.plan_table_splits(status_df(spark, [(1, 5)]).limit(0), 100).count() == 0
    only = ts.plan_table_splits(status_df(spark, [(1, M), (2, 5)]), 100, include_archived=False).collect()
    assert [(r.file_id, r.split_id, r.remainSize) for r in only] == [(2, 0, 5)]
    for bad in (-1, None):
        with pytest.raises(Exception, match="for file 7"):
            ts.plan_table_splits(spark.createDataFrame([(7, bad)], "file_id bigint, remainSize bigint"), 100).collect()
    with pytest.raises(ValueError):
        ts.plan_table_splits(status_df(spark, [(1, 5)]), 1 << 60)


def test_rounds_send_no_classes_through_the_driver(spark, monkeypatch):
    rnd = random.Random(3)
    sizes = [(fid, rnd.choice([0, 7, 30, 99, 130])) for fid in range(600)]
    seen, write = [], ts.materialise

    def kept(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(ts, "materialise", kept)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")  # Spark's own default
    try:
        out = ts.plan_table_splits(status_df(spark, sizes).repartition(3), 100, 20)
        plans = [p for n, p in seen if n == "chain"][1:] + [p for n, p in seen if n == "jumps"][1:]
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        assert len(plans) > 6 and not any("BroadcastHashJoin" in p for p in plans)
        assert {r.file_id: r.split_id for r in out.collect()} == fold(sizes, 100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_run_classes_follow_the_chain_over_pieces():
    rnd = random.Random(8)
    for _ in range(200):
        sizes = np.array([rnd.choice([0, 0, 1, 3, 10, 25]) for _ in range(rnd.randint(1, 60))])
        run, at = ts.RunClasses(25), 0
        while at < len(sizes):
            n = rnd.randint(1, 12)
            run.extend(sizes[at:at + n])
            at += n
        before = np.cumsum(sizes) - sizes
        assert (run.bytes, run.last) == (sizes.sum(), before[-1])
        for place in range(int(min(25, before[-1])) + 1):  # what a split from before the run can end at
            i, n = int(np.searchsorted(before, place)), 1
            while (j := int(np.searchsorted(before, before[i] + 25))) < len(sizes):
                i, n = j, n + 1
            k = int(np.searchsorted(run.upto, place))
            leaves = int(run.leaves[k])
            assert leaves > run.last and (leaves, run.starts[k]) == (before[i] + 25, n)


@pytest.mark.parametrize("cap, sizes", [(100, [0, 1, 7, 30, 99, 130]), (5000, [0, 1, 2]), (1 << 57, [M, 1 << 56, (1 << 57) - 1, 5])])
def test_cut_runs_equal_the_sequential_fold(spark, monkeypatch, cap, sizes):
    monkeypatch.setattr(ts, "_RUN_CLASSES", 4)
    monkeypatch.setattr(ts, "_PIECE_FILES", 9)
    rnd = random.Random(11)
    files = [(fid, rnd.choice(sizes)) for fid in rnd.sample([*range(900), *range(10**12, 10**12 + 900)], 400)]
    got = {r.file_id: r.split_id for r in ts.plan_table_splits(status_df(spark, files).repartition(5), cap, 16).collect()}
    assert got == fold([(fid, min(size, cap)) for fid, size in files], cap)


def test_rounds_work_on_runs_of_blocks(spark, monkeypatch):
    rnd = random.Random(4)
    sizes = [(fid, rnd.choice([0, 7, 30, 99, 130])) for fid in range(3000)]
    seen, write = [], ts.materialise

    def kept(df, name):
        out = write(df, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(ts, "materialise", kept)
    out = ts.plan_table_splits(status_df(spark, sizes).repartition(3), 100, 10)  # 300 blocks
    assert max(n for name, n in seen if name in ("classes", "jumps", "chain")) < 150
    assert sum(name == "jumps" for name, _ in seen) <= 6
    assert {r.file_id: r.split_id for r in out.collect()} == fold(sizes, 100)
