"""Physical-plan checks: pruning and pushdown at the scan, shuffle placement, no Python on
the aggregation spine, co-located joins with a bucketed index."""

import os

from pyspark.sql import functions as F

from blobtally.operators import refs, status
from blobtally.sources import tables, write_bucketed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _store(fx, root):
    paths = {}
    for name in ["objects_raw", "blob_index", "file_index", "file_lengths"]:
        paths[name] = os.path.join(root, name)
        getattr(fx, name).write.parquet(paths[name])
    return paths


def test_status_spine_prunes_pushes_and_stays_in_jvm(spark, fx, tmp_dir):
    p = _store(fx, tmp_dir)
    r = refs.object_refs(tables.read_objects(spark, p["objects_raw"]))
    st = status.file_status(r, tables.read_blob_index(spark, p["blob_index"]),
                            tables.read_file_index(spark, p["file_index"]),
                            tables.read_file_lengths(spark, p["file_lengths"]), "archive")
    plan = _plan(st)
    # Only the columns used are read; null checks reach the Parquet reader.
    assert "ReadSchema: struct<uri:string,file_id:bigint,length:bigint>" in plan
    assert "PushedFilters: [IsNotNull(uri), IsNotNull(size)]" in plan
    # Partial aggregation before each shuffle of the aggregates; no Python anywhere.
    assert plan.count("partial_count") >= 1 and "partial_sum" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    # No broadcast is planned from size estimates; AQE may add one later from measured sizes.
    assert "BroadcastExchange" not in plan


def test_bucketed_blob_index_is_not_shuffled(spark, fx, tmp_dir):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(fx.blob_index, "blob_index_bucketed", "uri", n, os.path.join(tmp_dir, "bi"))
    p = _store(fx, tmp_dir)
    r = refs.object_refs(tables.read_objects(spark, p["objects_raw"]))
    totals = status.file_totals(r, tables.read_blob_index(spark, spark.table("blob_index_bucketed")), "archive")
    plan = _plan(totals)
    assert "Bucketed: true" in plan
    # One shuffle by uri (the per-uri aggregation) and one by file_id; none for the index.
    assert plan.count("Exchange hashpartitioning(uri") == 1
    unbucketed = _plan(status.file_totals(r, fx.blob_index, "archive"))
    assert unbucketed.count("Exchange hashpartitioning(uri") == 2
    assert totals.count() == status.file_totals(r, fx.blob_index, "archive").count()


def test_split_fold_reads_sorted_exact_partitions(spark, fx):
    from blobtally.operators import compact

    st = status.file_status(refs.object_refs(fx.objects_raw), fx.blob_index, fx.file_index,
                            fx.file_lengths, "archive")
    plan = _plan(compact.plan_splits(st, 4194304, 16))
    lines = [ln.strip(" :+-") for ln in plan.splitlines()]
    i = next(k for k, ln in enumerate(lines) if ln.startswith("MapInPandas"))
    # Directly below the fold: the in-partition sort, then the exchange by group.
    assert any(ln.startswith("Sort [pack_group") and "file_id" in ln for ln in lines[i + 1:i + 4])
    assert any("hashpartitioning(pack_group" in ln for ln in lines[i + 2:i + 6])


def test_meta_with_bucketed_index_shuffles_only_references(spark, fx, tmp_dir):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(fx.blob_index, "blob_index_bucketed_meta", "uri", n, os.path.join(tmp_dir, "bi"))
    p = _store(fx, tmp_dir)
    r = refs.object_refs(tables.read_objects(spark, p["objects_raw"]))
    idx = tables.read_blob_index(spark, spark.table("blob_index_bucketed_meta"))
    st_path = os.path.join(tmp_dir, "status")
    status.file_status(r, idx, tables.read_file_index(spark, p["file_index"]),
                       tables.read_file_lengths(spark, p["file_lengths"]), "archive").write.parquet(st_path)
    st = tables.read_file_status(spark, st_path)
    meta = status.file_meta(r, idx, st, "archive", broadcast_files=1_000_000)
    plan = _plan(meta)
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning(uri") == 1     # the references only
    assert "BroadcastExchange" in plan                            # the checked file-id set
    assert "Exchange hashpartitioning(file_id" not in plan
    assert meta.count() == status.file_meta(r, fx.blob_index, st, "archive").count()


def test_meta_beyond_the_broadcast_bound_leaves_the_bucketed_index_in_place(spark, fx, tmp_dir):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(fx.blob_index, "blob_index_bucketed_far", "uri", n, os.path.join(tmp_dir, "bi"))
    p = _store(fx, tmp_dir)
    r = refs.object_refs(tables.read_objects(spark, p["objects_raw"]))
    idx = tables.read_blob_index(spark, spark.table("blob_index_bucketed_far"))
    st_path = os.path.join(tmp_dir, "status")
    status.file_status(r, idx, tables.read_file_index(spark, p["file_index"]),
                       tables.read_file_lengths(spark, p["file_lengths"]), "archive").write.parquet(st_path)
    st = tables.read_file_status(spark, st_path)
    # Status rows that repeat (two runs read together) must not multiply the meta rows.
    far = status.file_meta(r, idx, st.unionByName(st), "archive", broadcast_files=0)
    plan = _plan(status.file_meta(r, idx, st, "archive", broadcast_files=0))
    assert "Bucketed: true" in plan and "BroadcastExchange" not in plan
    assert plan.count("Exchange hashpartitioning(uri") == 1       # the references only
    assert plan.count("Exchange hashpartitioning(file_id") == 2   # meta rows, file ids
    near = status.file_meta(r, idx, st, "archive", broadcast_files=1_000_000)
    assert far.exceptAll(near).count() == 0 and near.exceptAll(far).count() == 0


def test_hot_keys_leave_a_bucketed_index_in_place(spark, fx, tmp_dir):
    from blobtally.operators import joins

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(fx.blob_index, "blob_index_bucketed_hot", "uri", n, os.path.join(tmp_dir, "bi"))
    p = _store(fx, tmp_dir)
    r = refs.object_refs(tables.read_objects(spark, p["objects_raw"]))
    idx = tables.read_blob_index(spark, spark.table("blob_index_bucketed_hot"))
    hot = [row.uri for row in r.select("uri").distinct().limit(3).collect()]
    plan = _plan(joins.lookup_join(r, idx, "uri", hot_keys=hot))
    # The cold references are the only thing that moves; hot index rows are broadcast.
    assert plan.count("Exchange hashpartitioning(uri") == 1 and "SortMergeJoin" in plan
    assert plan.count("BroadcastHashJoin") >= 2 and "_salt" not in plan


def test_the_status_pass_fills_the_sketch(spark, fx):
    r = refs.object_refs(fx.objects_raw)
    twice = r.unionByName(r.select("object_key", F.lit("1-1").alias("uri"), "size"))
    st, observed = status.file_status(twice, fx.blob_index, fx.file_index, fx.file_lengths, "archive", observe=True, sketch_hot_keys=True)
    st.count()
    from blobtally.operators import joins

    found = {k: v for obs in observed for k, v in obs.get.items()}
    assert joins.hot_keys_of(found["hot_keys"], 1000) == ["1-1"] and found["hits"] > 0
