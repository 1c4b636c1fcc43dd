"""Benchmark of the headline queries.

Reads testdata at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] (default 8).
The store tables (objects as raw bytes, blob index, file index, file lengths, key-value
records) are derived from testdata once and written as Parquet to a fresh scratch folder, so
the timed queries read Parquet exactly as they would read the store (scan pruning and
pushdown included); the blob index is stored bucketed by uri, the recommended layout. Each
query runs once to warm up and three times timed; the median is reported (the warm-up round
runs over all queries before any timed round). Results are
consumed by the ``noop`` sink: fully computed, nothing collected.

Prints one JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from blobtally import schemas  # noqa: E402
from blobtally.operators import cells, compact, refs, status  # noqa: E402
from blobtally.operators.joins import find_hot_keys  # noqa: E402
from blobtally.plans import jobs, sinks  # noqa: E402
from blobtally.session import get_session  # noqa: E402
from blobtally.sources import tables, write_bucketed  # noqa: E402
from blobtally.sources.fixtures import (  # noqa: E402
    ARCHIVE_BUCKET,
    CELL_FAMILY,
    KEY_DELIMITER,
    MAX_BYTES,
    FILES_PER_GROUP,
    START_KEYS,
    Fixtures,
)

SKEW_ROWS = 1_000_000


def materialise(spark, sf_dir, root, files=None, bucket_index=False):
    """Write the derived store tables as Parquet, each spread over ``files`` files (a real
    store table is many files; one small file would make every scan a single task).

    With ``bucket_index`` the blob index is stored bucketed by uri into as many buckets as the
    session's shuffle partitions (the recommended layout: joins on uri then never shuffle it).
    """
    fx = Fixtures(spark, sf_dir)
    files = files or spark.sparkContext.defaultParallelism
    out = {"root": root}
    for name in ["objects_raw", "blob_index", "file_index", "file_lengths", "cell_source"]:
        p = os.path.join(root, "store", name)
        getattr(fx, name).repartition(files).write.mode("overwrite").parquet(p)
        out[name] = p
    if bucket_index:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        out["blob_index_table"] = write_bucketed(spark.read.parquet(out["blob_index"]), "bench_blob_index",
                                                 "uri", n, os.path.join(root, "store", "blob_index_bucketed"))
    return out


class Store:
    def __init__(self, spark, paths):
        self.spark = spark
        self.paths = paths

    def refs(self):
        return refs.object_refs(tables.read_objects(self.spark, self.paths["objects_raw"]))

    def blobs(self):
        if "blob_index_table" in self.paths:
            return tables.read_blob_index(self.spark, self.spark.table(self.paths["blob_index_table"]))
        return tables.read_blob_index(self.spark, self.paths["blob_index"])

    def status(self):
        return status.file_status(self.refs(), self.blobs(),
                                  tables.read_file_index(self.spark, self.paths["file_index"]),
                                  tables.read_file_lengths(self.spark, self.paths["file_lengths"]),
                                  ARCHIVE_BUCKET)

    def written_status(self):
        """Status computed once and written to the scratch folder (cuts the lineage)."""
        path = os.path.join(self.paths["root"], f"status-{time.time_ns()}")
        return tables.read_file_status(self.spark, sinks.write_file_status(self.status(), path))

    def hot_keys(self):
        """Hot uris from a sample of the object table's files (the aggregate job sketches them in its status pass)."""
        files, ratio = tables.sample_input_files(self.spark, self.paths["objects_raw"], schemas.RAW_OBJECTS, 0.01)
        return find_hot_keys(refs.object_refs(tables.read_objects(self.spark, files)), "uri", SKEW_ROWS, presampled=ratio)

    def meta(self, st=None):
        return status.file_meta(self.refs(), self.blobs(), st if st is not None else self.status(),
                                ARCHIVE_BUCKET, KEY_DELIMITER, hot_keys=self.hot_keys())


def bench_queries(store):
    spark = store.spark
    return {
        "file_status": lambda: store.status(),
        "file_meta": lambda: store.meta(),
        "split_assignment": lambda: compact.plan_splits(store.status(), MAX_BYTES, FILES_PER_GROUP),
        "relocation_plan": lambda: (lambda st: compact.plan_relocation(
            compact.plan_splits(st, MAX_BYTES, FILES_PER_GROUP), store.meta(st), KEY_DELIMITER))(
                store.written_status()),
        "region_bucket": lambda: cells.add_region(
            cells.to_cells(spark.read.parquet(store.paths["cell_source"]), "row_key", CELL_FAMILY,
                           {"name": "name", "segment": "segment"}), START_KEYS),
    }


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="blobtally-bench-")
    spark = get_session(f"local[{cpus}]", app="blobtally-bench", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": "16g",
                               "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
                               "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    t0 = time.time()
    store = Store(spark, materialise(spark, sf_dir, scratch, bucket_index=True))
    prep = time.time() - t0

    # One warm-up round over every query first (so no query pays the JIT warm-up for the
    # others), then ``runs`` timed rounds; each query's median is reported.
    queries = dict(bench_queries(store))
    queries["aggregate_job"] = lambda out: jobs.run_aggregate(
        spark, store.paths["objects_raw"], store.blobs(), store.paths["file_index"],
        store.paths["file_lengths"], out, archive_bucket=ARCHIVE_BUCKET, skew_rows=SKEW_ROWS)
    samples = {name: [] for name in queries}
    for i in range(runs + 1):
        for name, build in queries.items():
            t = time.time()
            if name == "aggregate_job":
                build(os.path.join(scratch, f"out{i}") + "/")
            else:
                build().write.format("noop").mode("overwrite").save()
            if i > 0:
                samples[name].append(time.time() - t)
    timings = {name: round(statistics.median(v), 3) for name, v in samples.items()}

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "prepare_sec": round(prep, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
