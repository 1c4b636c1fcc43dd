"""Cells are published once: retried tasks, failed runs, overlapping files."""

import os
import subprocess
import sys

import pytest

from blobtally.operators import cells, compact
from blobtally.sources import DirectoryCellStore, put_cells, read_cell_store, read_manifest
from blobtally.sources.cell_store import overlaps

RETRY = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from blobtally.operators import cells
from blobtally.sources import DirectoryCellStore, put_cells, read_cell_store

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()

class Fails(DirectoryCellStore):
    def open(self, attempt):
        writer = super().open(attempt)
        part, first = TaskContext.get().partitionId(), TaskContext.get().attemptNumber() == 0
        class Once:
            def write(self, batch):
                writer.write(batch)
                if part == 1 and first:
                    writer.close()
                    raise IOError("the store went away after some cells")
            def close(self):
                return writer.close()
        return Once()
    def discard(self, attempts):  # as if the executor had died: nothing is cleaned up
        pass

df = spark.range(0, 1000, numPartitions=4).selectExpr("encode(cast(id as string), 'UTF-8') AS row_key", "cast(id as string) AS v")
put_cells(cells.to_cells(df, "row_key", "f", {"v": "v"}), Fails(sys.argv[2]))
got = [bytes(r.row_key).decode() for r in read_cell_store(spark, sys.argv[2]).collect()]
left = sum(len(f) for _, _, f in os.walk(os.path.join(sys.argv[2], "attempts")))
print("RESULT", len(got), len(set(got)), left)
"""


def test_a_retried_task_writes_once(tmp_dir):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", RETRY, repo, os.path.join(tmp_dir, "store")], capture_output=True, text=True, timeout=300)
    said = [line for line in out.stdout.splitlines() if line.startswith("RESULT")]
    assert said == ["RESULT 1000 1000 1"], out.stderr[-2000:]  # the failed attempt's file is left, and not read


def _cells(spark, n=100):
    return cells.to_cells(spark.range(n).selectExpr("encode(lpad(id, 4, '0'), 'UTF-8') AS row_key", "id AS v"), "row_key", "f", {"v": "v"})


def test_a_failed_run_publishes_nothing(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    put_cells(_cells(spark), DirectoryCellStore(store))

    class Broken(DirectoryCellStore):
        def open(self, attempt):
            if attempt.startswith("000001"):
                raise OSError("no store")
            return super().open(attempt)

    with pytest.raises(Exception, match="no store"):
        put_cells(_cells(spark, 50).repartition(3), Broken(store))
    assert read_cell_store(spark, store).count() == 100 and read_manifest(spark, store).select("file").distinct().count() >= 1
    put_cells(_cells(spark, 7), DirectoryCellStore(store))  # appends
    assert read_cell_store(spark, store).count() == 107
    put_cells(_cells(spark, 7), DirectoryCellStore(store, replace=True))
    assert read_cell_store(spark, store).count() == 7


def test_overlapping_files_are_not_published(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    with pytest.raises(Exception, match="overlap"):
        put_cells(_cells(spark).repartition(4), DirectoryCellStore(store, disjoint=True))  # not sorted by ranges
    assert not os.path.exists(os.path.join(store, "data"))
    entry = {f"{e}_{c}": b"a" for e in ("first", "last") for c in ("row_key", "family", "qualifier")}
    assert overlaps([entry | {"file": "x"}, entry | {"file": "y"}]) == [("x", "y")]
    assert overlaps([entry | {"file": "x"}, entry | {"file": "y", "first_qualifier": b"b", "last_row_key": b"b"}]) == []


def test_hook_streams_each_split_in_order(spark):
    rows = [(g, s, f, f"b{i}", i * 10, 10, i * 10) for g in range(2) for s in range(3) for f in (1,) for i in range(s * 4000 + 1)]
    plan = spark.createDataFrame(rows, "pack_group bigint, split_id int, file_id bigint, blob_id string, start bigint, length bigint, new_start bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        def hook(split, batches):
            n, at, parts, gaps = 0, 0, 0, 0
            for b in batches:
                parts += 1
                for start, length in zip(b.column("new_start").to_pylist(), b.column("length").to_pylist()):
                    gaps += start != at
                    at = start + length
                    n += 1
            return {"n": n, "bytes": at, "gaps": gaps, "parts": parts}

        got = {(r.pack_group, r.split_id): r for r in
               compact.apply_to_splits(plan.repartition(4), hook, "n bigint, bytes bigint, gaps bigint, parts int").collect()}
        assert {k: (r.n, r.bytes, r.gaps) for k, r in got.items()} == {(g, s): (s * 4000 + 1, (s * 4000 + 1) * 10, 0) for g in range(2) for s in range(3)}
        assert got[0, 2].parts > 5  # the split came in pieces
        first = compact.apply_to_splits(plan, lambda split, batches: {"blob": next(batches).column("blob_id")[0].as_py()}, "blob string")
        assert {r.blob for r in first.collect()} == {"b0"}  # a hook may leave the rest unread
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
