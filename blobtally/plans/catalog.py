"""The query catalogue: one Spark plan per operator group, over fixtures derived from testdata.

Every entry takes (spark, sf_dir) and returns a DataFrame whose columns equal those of the
matching text in ``blobtally.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobtally.functions.columns import (
    cell_label,
    millis_instant,
    ntz_epoch_millis,
    run_day,
    run_file_meta_path,
    run_file_status_path,
    run_timestamp,
)
from blobtally.operators import cells as cell_ops
from blobtally.operators import compact, refs, status, table_splits
from blobtally.plans import jobs, sinks
from blobtally.plans.layout import catalog_runs
from blobtally.session import scratch_path
from blobtally.sources import DirectoryCellStore, list_tree, put_cells, read_cell_store, read_manifest, tables
from blobtally.sources.cell_store import local_path
from blobtally.sources.fixtures import (
    ARCHIVE_BUCKET,
    CELL_FAMILY,
    KEY_DELIMITER,
    MAX_BYTES,
    FILES_PER_BLOCK,
    FILES_PER_GROUP,
    GROUPS_PER_TAIL,
    START_KEYS,
    Fixtures,
)

# Parameters of the catalogued queries (fixed, shared with the oracle texts).
SAMPLE_FRACTION = 0.01
DELETE_MIN_EMPTY_PERCENT = 90
RUN_BASE = "/data/blobstore/"
LIST_ROWS = 5
REF_FRACTION = 0.375
HOT_ROWS = 40
RUN_AT = datetime(2017, 9, 17, 15, 18, 34, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


def _refs(fx: Fixtures) -> DataFrame:
    return refs.object_refs(tables.read_objects(fx.spark, fx.objects_raw))


def _resolved(fx: Fixtures) -> DataFrame:
    return refs.resolve_refs(_refs(fx), fx.blob_index)


def _status(fx: Fixtures) -> DataFrame:
    return status.file_status(_refs(fx), fx.blob_index, fx.file_index, fx.file_lengths, ARCHIVE_BUCKET)


def _meta(fx: Fixtures, file_status: DataFrame | None = None) -> DataFrame:
    st = file_status if file_status is not None else _status(fx)
    return status.file_meta(_refs(fx), fx.blob_index, st, ARCHIVE_BUCKET, KEY_DELIMITER)


def _hex_cells(df: DataFrame) -> list:
    return [F.hex("row_key").alias("row_key_hex"), F.hex("family").alias("family_hex"),
            F.hex("qualifier").alias("qualifier_hex")]


def _cells(fx: Fixtures) -> DataFrame:
    return cell_ops.to_cells(fx.cell_source, "row_key", CELL_FAMILY,
                             {"name": "name", "segment": "segment"})


def _assignment(fx: Fixtures) -> DataFrame:
    return compact.plan_splits(_status(fx), MAX_BYTES, FILES_PER_GROUP)


def _run_paths(fx: Fixtures) -> DataFrame:
    r = fx.run_times
    day, millis = run_day("run_ts"), ntz_epoch_millis("run_ts")
    return r.select("o_orderkey",
                    run_file_status_path(RUN_BASE, day, millis).alias("status_path"),
                    run_file_meta_path(RUN_BASE, day, millis).alias("meta_path"))


# --- queries ---------------------------------------------------------------------------------

def q_object_scan(spark, sf_dir):
    raw = tables.read_objects(spark, _fx(spark, sf_dir).objects_raw)
    return raw.select(F.hex("row_key").alias("row_key_hex"), F.hex("uri").alias("uri_hex"),
                      F.hex("size").alias("size_hex"))


def q_valid_objects(spark, sf_dir):
    raw = tables.read_objects(spark, _fx(spark, sf_dir).objects_raw)
    return refs.decode_objects(refs.valid_objects(raw))


def q_decode_cells(spark, sf_dir):
    return refs.decode_objects(tables.read_objects(spark, _fx(spark, sf_dir).objects_raw))


def q_object_refs(spark, sf_dir):
    return _refs(_fx(spark, sf_dir))


def q_resolve_refs(spark, sf_dir):
    return _resolved(_fx(spark, sf_dir))


def q_unresolved_refs(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return refs.unresolved_refs(_refs(fx), fx.blob_index)


def q_lookup_counters(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return refs.lookup_counters(_refs(fx), fx.blob_index)


def q_ref_count(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return refs.ref_count(_refs(fx), fx.blob_index)


def q_sampled_refs(spark, sf_dir):
    return refs.sample_refs(_resolved(_fx(spark, sf_dir)), SAMPLE_FRACTION, key=refs.blob_sample_key())


def q_archived_flag(spark, sf_dir):
    return status.archived_flag(_fx(spark, sf_dir).objects, ARCHIVE_BUCKET)


def q_live_refs(spark, sf_dir):
    return status.live_refs(_resolved(_fx(spark, sf_dir)), ARCHIVE_BUCKET)


def q_file_totals(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return status.file_totals(_refs(fx), fx.blob_index, ARCHIVE_BUCKET) \
        .select("file_id", "n_refs", "n_live", "remain_size", "all_archived")


def q_file_paths(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    totals = status.file_totals(_refs(fx), fx.blob_index, ARCHIVE_BUCKET)
    return status.file_paths(totals, fx.file_index) \
        .select("file_id", "path", "n_refs", "n_live", "remain_size", "all_archived")


def q_file_lengths(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    totals = status.file_totals(_refs(fx), fx.blob_index, ARCHIVE_BUCKET)
    return status.file_lengths_join(status.file_paths(totals, fx.file_index), fx.file_lengths) \
        .select("file_id", "path", "length", "all_archived")


def q_file_outcomes(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    totals = status.file_totals(_refs(fx), fx.blob_index, ARCHIVE_BUCKET)
    return status.outcome_counts(status.file_outcomes(totals, fx.file_index, fx.file_lengths))


def q_file_status(spark, sf_dir):
    return _status(_fx(spark, sf_dir))


def q_file_meta(spark, sf_dir):
    return _meta(_fx(spark, sf_dir))


def q_file_meta_lists(spark, sf_dir):
    return status.file_meta_lists(_meta(_fx(spark, sf_dir)), KEY_DELIMITER)


def _lists(fx: Fixtures) -> DataFrame:
    return status.meta_lists(_meta(fx), LIST_ROWS, KEY_DELIMITER)


def q_file_meta_numbered(spark, sf_dir):
    # The lists themselves, each written out as text in its own order.
    return _lists(_fx(spark, sf_dir)).select(
        "file_id", "list_no", F.size("rows").cast("bigint").alias("n_rows"),
        F.array_join(F.transform("rows", lambda r: F.concat(r["meatRowKey"], F.lit("="), r["objectKey"])), ",").alias("listed"))


def q_file_meta_flat(spark, sf_dir):
    return status.flatten_lists(_lists(_fx(spark, sf_dir)))


def q_nested_objects(spark, sf_dir):
    # The nested form as text, and its fields taken out of it again.
    nested = refs.nest_refs(_resolved(_fx(spark, sf_dir)))
    return refs.flatten_refs(nested.select("*", F.to_json("blob_info").alias("nested")), "nested")


def q_status_roundtrip(spark, sf_dir):
    path = sinks.write_file_status(_status(_fx(spark, sf_dir)), scratch_path(spark, "file_status"))
    return tables.read_file_status(spark, path)


def q_status_row_count(spark, sf_dir):
    path = sinks.write_file_status(_status(_fx(spark, sf_dir)), scratch_path(spark, "file_status"))
    return tables.read_file_status(spark, path).agg(F.count(F.lit(1)).alias("n_rows"))


def q_run_path_columns(spark, sf_dir):
    return _run_paths(_fx(spark, sf_dir))


def q_run_catalog(spark, sf_dir):
    p = _run_paths(_fx(spark, sf_dir))
    k = F.col("o_orderkey") % 3
    run_path = (F.when(k == 0, F.col("status_path"))
                .when(k == 1, F.concat(F.col("meta_path"), F.lit("/")))
                .otherwise(F.replace(F.col("status_path"), F.lit("/file_status"),
                                     F.lit("/latest/file_status"))))
    return p.select("o_orderkey", run_path.alias("run_path")) \
        .withColumn("run_ts", run_timestamp("run_path"))


def q_split_assignment(spark, sf_dir):
    return _assignment(_fx(spark, sf_dir)).select("file_id", "pack_group", "split_id")


def q_merged_tails(spark, sf_dir):
    merged = compact.plan_splits(_status(_fx(spark, sf_dir)), MAX_BYTES, FILES_PER_GROUP, merge_tails=True,
                                 groups_per_tail=GROUPS_PER_TAIL)
    return merged.select("file_id", "pack_group", "split_id")


def q_custom_cells(spark, sf_dir):
    # A function of the record, over integers beyond 2^53 with nulls between them.
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    number = F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey") + F.lit(9007199254740993))

    def cells(record: dict):
        value = None if record["number"] is None else str(record["number"]).encode()
        yield f"{record['c_custkey']:09d}".encode(), b"f", b"number", value

    out = cell_ops.flat_map_cells(customer.select("c_custkey", number.alias("number")), cells)
    return out.select(F.hex("row_key").alias("row_key_hex"), F.hex("value").alias("value_hex"))


def q_split_summary(spark, sf_dir):
    return compact.split_summary(_assignment(_fx(spark, sf_dir)))


def q_relocation_plan(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    # The status feeds both the split plan and the meta: computed once and written as a table in
    # the shared checkpoint folder, which cuts the lineage (as the aggregate job does).
    st = tables.read_file_status(spark, sinks.write_file_status(_status(fx), scratch_path(spark, "file_status")))
    return compact.plan_relocation(compact.plan_splits(st, MAX_BYTES, FILES_PER_GROUP), _meta(fx, st),
                                   KEY_DELIMITER)


def q_marked_deleted(spark, sf_dir):
    return compact.mark_deleted(_status(_fx(spark, sf_dir)), min_empty_percent=DELETE_MIN_EMPTY_PERCENT)


def q_cells(spark, sf_dir):
    c = _cells(_fx(spark, sf_dir))
    return c.select(*_hex_cells(c), F.hex("value").alias("value_hex"))


def q_cell_labels(spark, sf_dir):
    return _cells(_fx(spark, sf_dir)).select(cell_label("row_key", "family", "qualifier").alias("label"))


def q_run_instants(spark, sf_dir):
    # Path -> epoch millis -> instant, shown as UTC wall clock whatever the session's zone.
    instant = millis_instant(run_timestamp("status_path"))
    utc = F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))
    return _run_paths(_fx(spark, sf_dir)).select("o_orderkey", F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSS").alias("run_at"))


def q_sorted_cells(spark, sf_dir):
    c = cell_ops.with_sort_position(_cells(_fx(spark, sf_dir)), cell_ops.CELL_ORDER)
    return c.select("pos", *_hex_cells(c))


def q_region_bucket(spark, sf_dir):
    c = cell_ops.add_region(_cells(_fx(spark, sf_dir)), START_KEYS)
    return c.select(*_hex_cells(c), "region")


def _start_keys(fx: Fixtures) -> DataFrame:
    """Start keys as a table: one for every supplier, over the customers' row keys."""
    key = F.col("s_suppkey") * 13
    return fx.table("supplier").select(F.encode(F.lpad(key.cast("string"), 9, "0"), "UTF-8").alias("start_key"))


def q_region_table(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    c = cell_ops.add_region(_cells(fx), _start_keys(fx))
    return c.select(*_hex_cells(c), "region")


def q_table_splits(spark, sf_dir):
    return table_splits.plan_table_splits(_status(_fx(spark, sf_dir)), MAX_BYTES, FILES_PER_BLOCK).select("file_id", "split_id")


def _check_split(split: dict, batches) -> dict:
    """Hook over a split's blobs in order: their number and bytes, holes and overlaps in the new file,
    and a sum that changes with their order."""
    n, at, holes, ordered, last = 0, 0, 0, 0, None
    for batch in batches:
        for start, length, blob in zip(*(batch.column(c).to_pylist() for c in ("new_start", "length", "blob_id"))):
            n += 1
            holes += start != at
            at = start + (length or 0)
            ordered += n * (length or 0)
            last = blob
    return {"n_blobs": n, "new_bytes": at, "holes": holes, "ordered_sum": ordered, "last_blob": last}


def q_split_checks(spark, sf_dir):
    return compact.apply_to_splits(q_relocation_plan(spark, sf_dir), _check_split,
                                   "n_blobs bigint, new_bytes bigint, holes bigint, ordered_sum bigint, last_blob string")


def _order_cells(fx: Fixtures) -> DataFrame:
    orders = fx.table("orders").select(F.encode(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), "UTF-8").alias("row_key"),
                                       F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))
    return cell_ops.to_cells(orders, "row_key", "o", {"status": "status", "customer": "customer"})


def q_put_cells(spark, sf_dir):
    # Written by calls on a store, read back from what it published.
    path = scratch_path(spark, "cell_store")
    put_cells(_order_cells(_fx(spark, sf_dir)), DirectoryCellStore(path))
    c = read_cell_store(spark, path)
    return c.select(*_hex_cells(c), F.hex("value").alias("value_hex"))


def q_bulk_load(spark, sf_dir):
    # Files read back: what each region holds, and whether every file keeps to its manifest entry.
    fx = _fx(spark, sf_dir)
    path = cell_ops.bulk_load_cells(_cells(fx), _start_keys(fx), scratch_path(spark, "bulk"), num_files=7)
    kept = read_manifest(spark, path).select("file", "n_cells", "first_row_key", "last_row_key")
    files = read_cell_store(spark, path).groupBy("region", "file").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_key").alias("low"), F.max("row_key").alias("high"))
    wrong = F.count_if((F.col("n") != F.col("n_cells")) | (F.col("low") != F.col("first_row_key")) | (F.col("high") != F.col("last_row_key")))
    return files.join(kept, "file").groupBy(F.col("region").cast("bigint").alias("region")).agg(
        F.sum("n").cast("bigint").alias("n_cells"), F.hex(F.min("low")).alias("first_hex"), F.hex(F.max("high")).alias("last_hex"), wrong.alias("wrong_entries"))


def _shared_refs(fx: Fixtures) -> DataFrame:
    """References of every object to one of five blobs that all share, beside its own."""
    own = _refs(fx)
    number = F.substring_index("object_key", "/", -1).cast("bigint")
    shared = fx.objects.select("object_key", F.concat((number % 5 * 32 + 1).cast("string"), F.lit("-1")).alias("uri"),
                               F.lit(1).cast("bigint").alias("size"))
    return own.unionByName(shared)


def q_hot_refs(spark, sf_dir):
    # Uris with many references take the broadcast of their index rows; the sketch finds them.
    fx = _fx(spark, sf_dir)
    return refs.resolve_refs(_shared_refs(fx), fx.blob_index, skew_rows=HOT_ROWS) \
        .groupBy("uri", "file_id", "blob_id").agg(F.count(F.lit(1)).alias("n_refs"), F.min("object_key").alias("first_object"),
                                                  F.max("object_key").alias("last_object"))


def _reference_digest():
    return F.md5(F.concat_ws("|", "object_key", F.col("ref_no").cast("string"), "uri"))


def q_thinned_totals(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    marked = refs.mark_sample(refs.object_refs(tables.read_objects(spark, fx.objects_raw), numbered=True), REF_FRACTION, _reference_digest())
    return status.file_totals(marked, fx.blob_index, ARCHIVE_BUCKET).select("file_id", "n_refs", "n_live", "remain_size", "all_archived")


def _run_job(spark, sf_dir, **options):
    """The aggregate job over written store tables, whose indexes also hold rows with null keys."""
    fx, store = _fx(spark, sf_dir), scratch_path(spark, "store")
    no_uri = fx.blob_index.limit(2).withColumn("uri", F.lit(None).cast("string"))
    no_id = fx.file_index.limit(2).withColumn("file_id", F.lit(None).cast("bigint"))
    inputs = {"objects": fx.objects_raw, "blobs": fx.blob_index.unionByName(no_uri), "files": fx.file_index.unionByName(no_id),
              "lengths": fx.file_lengths}
    for name, df in inputs.items():
        df.write.parquet(f"{store}/{name}")
    base = scratch_path(spark, "runs") + "/"
    done = jobs.run_aggregate(spark, *(f"{store}/{name}" for name in inputs), base, RUN_AT, archive_bucket=ARCHIVE_BUCKET,
                              key_delimiter=KEY_DELIMITER, **options)
    return base, done


def q_job_status(spark, sf_dir):
    base, done = _run_job(spark, sf_dir)
    # The status rows read back from the run's place, with what the catalogue of runs says of that run.
    rows = tables.read_run_file_status(spark, base, done.status_path[len(base):]) \
        .withColumn("run_ts", run_timestamp(F.lit(done.status_path)))
    return rows.join(catalog_runs(spark, base).groupBy("run_ts", "day").agg(F.count(F.lit(1)).alias("n_outputs")), "run_ts")


def q_job_meta(spark, sf_dir):
    base, done = _run_job(spark, sf_dir, skew_rows=2, ref_fraction=REF_FRACTION, ref_digest=_reference_digest())
    return tables.read_run_file_meta(spark, base, done.meta_path[len(base):])


def q_job_counters(spark, sf_dir):
    _, done = _run_job(spark, sf_dir)
    names = ["hits", "misses", "files", "files_no_entry", "files_no_path", "files_no_length"]
    row = [done.exit_code, *(done.counters[n] for n in names)]
    return spark.createDataFrame([row], "exit_code int, " + ", ".join(f"{n} bigint" for n in names))


def q_job_splits(spark, sf_dir):
    base, done = _run_job(spark, sf_dir)
    compacted = jobs.run_compact(spark, base, done.status_path[len(base):], scratch_path(spark, "plan"), max_bytes=MAX_BYTES,
                                 files_per_group=FILES_PER_GROUP, merge_tails=True, groups_per_tail=GROUPS_PER_TAIL)
    splits = spark.read.parquet(compacted.splits_path)
    return compact.split_summary(splits).withColumn("run_ts", F.lit(compacted.run_ts).cast("bigint"))


def q_listed_files(spark, sf_dir):
    # Blob files written as a tree of folders, as many bytes as the file has blobs (some have none), and listed.
    fx, root = _fx(spark, sf_dir), local_path(scratch_path(spark, "tree"))
    sized = fx.blob_index.groupBy("file_id").agg(F.when(F.col("file_id") % 9 == 4, 0).otherwise(F.count(F.lit(1))).cast("bigint").alias("n"))

    def write(batches):
        import os

        for batch in batches:
            for file_id, n in zip(batch.column("file_id").to_pylist(), batch.column("n").to_pylist()):
                folder = f"{root}/d{file_id % 7}/e{file_id % 3}"
                os.makedirs(folder, exist_ok=True)
                with open(f"{folder}/f{file_id}", "wb") as out:
                    out.write(b"x" * n)
            yield batch

    sized.mapInArrow(write, sized.schema).write.format("noop").mode("overwrite").save()
    return list_tree(spark, root).select(F.substring("path", len(root) + 2, 1000).alias("file"), "length")


QUERIES: dict[str, Query] = {
    "object_scan": q_object_scan,
    "valid_objects": q_valid_objects,
    "decode_cells": q_decode_cells,
    "object_refs": q_object_refs,
    "resolve_refs": q_resolve_refs,
    "unresolved_refs": q_unresolved_refs,
    "lookup_counters": q_lookup_counters,
    "ref_count": q_ref_count,
    "sampled_refs": q_sampled_refs,
    "archived_flag": q_archived_flag,
    "live_refs": q_live_refs,
    "file_totals": q_file_totals,
    "file_paths": q_file_paths,
    "file_lengths": q_file_lengths,
    "file_outcomes": q_file_outcomes,
    "file_status": q_file_status,
    "file_meta": q_file_meta,
    "file_meta_lists": q_file_meta_lists,
    "file_meta_flat": q_file_meta_flat,
    "file_meta_numbered": q_file_meta_numbered,
    "nested_objects": q_nested_objects,
    "status_roundtrip": q_status_roundtrip,
    "status_row_count": q_status_row_count,
    "run_path_columns": q_run_path_columns,
    "run_catalog": q_run_catalog,
    "run_instants": q_run_instants,
    "split_assignment": q_split_assignment,
    "split_summary": q_split_summary,
    "merged_tails": q_merged_tails,
    "custom_cells": q_custom_cells,
    "relocation_plan": q_relocation_plan,
    "marked_deleted": q_marked_deleted,
    "cells": q_cells,
    "cell_labels": q_cell_labels,
    "sorted_cells": q_sorted_cells,
    "region_bucket": q_region_bucket,
    "region_table": q_region_table,
    "table_splits": q_table_splits,
    "split_checks": q_split_checks,
    "put_cells": q_put_cells,
    "bulk_load": q_bulk_load,
    "hot_refs": q_hot_refs,
    "thinned_totals": q_thinned_totals,
    "job_status": q_job_status,
    "job_meta": q_job_meta,
    "job_counters": q_job_counters,
    "job_splits": q_job_splits,
    "listed_files": q_listed_files,
}
