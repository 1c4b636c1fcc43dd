"""Jobs end to end, sinks, run layout, and the file-length listing source."""

import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from blobtally import schemas
from blobtally.operators import refs, status
from blobtally.plans import jobs
from blobtally.plans.layout import catalog_runs
from blobtally.sources import list_file_lengths, list_tree, read_file_status, read_run_file_meta, read_run_file_status, stat_file_lengths

WHEN = datetime(2017, 9, 17, 15, 18, 34, tzinfo=timezone.utc)


def _write_inputs(fx, root):
    paths = {}
    for name in ["objects_raw", "blob_index", "file_index", "file_lengths"]:
        p = os.path.join(root, "in", name)
        getattr(fx, name).write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def test_aggregate_then_compact(spark, fx, tmp_dir):
    inputs = _write_inputs(fx, tmp_dir)
    base = tmp_dir.rstrip("/") + "/"
    res = jobs.run_aggregate(spark, inputs["objects_raw"], inputs["blob_index"], inputs["file_index"],
                             inputs["file_lengths"], base, WHEN, archive_bucket="archive")
    assert res.exit_code == 0
    assert res.status_path.endswith("aggregator/2017-09-17/1505661514000/file_status")
    assert res.meta_path.endswith("aggregator/2017-09-17/1505661514000/file_meta")
    # Both outputs survive (the meta write must not replace the status output).
    st = read_file_status(spark, res.status_path)
    meta = spark.read.parquet(res.meta_path)
    assert st.columns == schemas.STATUS_COLUMNS and meta.columns == schemas.META_COLUMNS
    r = refs.object_refs(fx.objects_raw)
    want = status.file_status(r, fx.blob_index, fx.file_index, fx.file_lengths, "archive")
    assert st.exceptAll(want).count() == 0 and want.exceptAll(st).count() == 0
    assert res.counters["hits"] + res.counters["misses"] == r.count()
    assert res.counters["files"] == st.count()

    comp = jobs.run_compact(spark, base, "aggregator/2017-09-17/1505661514000/file_status",
                            os.path.join(tmp_dir, "plan"), max_bytes=4194304, files_per_group=16,
                            meta_sub_path="aggregator/2017-09-17/1505661514000/file_meta")
    assert comp.run_ts == 1505661514000
    assert comp.counters["input_rows"] == st.count()
    splits = spark.read.parquet(comp.splits_path)
    assert splits.count() == st.count()
    reloc = spark.read.parquet(comp.relocation_path)
    assert reloc.count() == meta.select("meatRowKey").distinct().count()

    runs = catalog_runs(spark, base).collect()
    assert {r.kind for r in runs} == {"file_status", "file_meta"}
    assert {r.run_ts for r in runs} == {1505661514000} and {r.day for r in runs} == {"2017-09-17"}


def test_aggregate_sampling_is_per_blob(spark, fx, tmp_dir):
    inputs = _write_inputs(fx, tmp_dir)
    base = tmp_dir.rstrip("/") + "/"
    res = jobs.run_aggregate(spark, inputs["objects_raw"], inputs["blob_index"], inputs["file_index"],
                             inputs["file_lengths"], base, WHEN, archive_bucket="archive",
                             sample_fraction=0.5)
    full = status.file_totals(refs.object_refs(fx.objects_raw), fx.blob_index, "archive")
    sampled = read_file_status(spark, res.status_path)
    assert 0 < sampled.count() <= full.count()
    # Sampled live bytes never exceed the full totals.
    j = sampled.filter(F.col("remainSize") != schemas.LONG_MAX).join(full, "file_id")
    assert j.filter(F.col("remainSize") > F.col("remain_size")).count() == 0
    meta = spark.read.parquet(res.meta_path)
    per_file = meta.groupBy(F.substring_index("meatRowKey", "_", 1).cast("bigint").alias("file_id")) \
        .agg(F.sum("length").alias("s"))
    jm = sampled.filter(F.col("remainSize") != schemas.LONG_MAX).join(per_file, "file_id", "left")
    assert jm.filter(F.coalesce(F.col("s"), F.lit(0)) != F.col("remainSize")).count() == 0


def test_list_file_lengths(spark, tmp_dir):
    store = os.path.join(tmp_dir, "blobstore")
    os.makedirs(os.path.join(store, "sub"))
    for name, size in [("f1", 10), ("sub/f2", 0), ("sub/f3", 1234)]:
        with open(os.path.join(store, name), "wb") as fh:
            fh.write(b"x" * size)
    got = {r.path: r.length for r in list_file_lengths(spark, store).collect()}
    assert got == {f"{store}/f1": 10, f"{store}/sub/f2": 0, f"{store}/sub/f3": 1234}
    assert list_tree(spark, f"{store}/sub").count() == 2 and list_tree(spark, f"{store}/nowhere").count() == 0
    assert {r.path for r in list_tree(spark, f"file:{store}/").collect()} == {f"file:{p}" for p in got}
    wanted = spark.createDataFrame([(f"{store}/f1",), (f"{store}/sub/f2",), (f"file:{store}/sub/f3",),
                                    (f"{store}/missing",)], "path string")
    got = {r.path: r.length for r in stat_file_lengths(wanted).collect()}
    assert got == {f"{store}/f1": 10, f"{store}/sub/f2": 0, f"file:{store}/sub/f3": 1234,
                   f"{store}/missing": None}


def test_status_roundtrip_keeps_names_and_types(spark, fx, tmp_dir):
    from blobtally.plans import sinks

    st = status.file_status(refs.object_refs(fx.objects_raw), fx.blob_index, fx.file_index,
                            fx.file_lengths, "archive")
    p = sinks.write_file_status(st, os.path.join(tmp_dir, "st"))
    back = spark.read.parquet(p)
    assert [(f.name, f.dataType.simpleString()) for f in back.schema.fields] == \
        [("file_id", "bigint"), ("emptyPercent", "int"), ("remainSize", "bigint"), ("path", "string"),
         ("deleted", "boolean")]


def _commit(spark, base, day, ts, df, attempt_only=False):
    from blobtally.plans.layout import Publication, RunPaths

    run_dir = f"{base}aggregator/{day}/{ts}"
    run = Publication(spark, RunPaths(day, ts, f"{run_dir}/file_status", f"{run_dir}/file_meta"))
    for kind in ("file_status", "file_meta"):
        df.write.parquet(run.staged(kind))
    run.commit({"rows": df.count()})
    if not attempt_only:
        run.settle()


def test_catalog_runs_lists_every_committed_run(spark, tmp_dir):
    from blobtally.plans.layout import read_commit

    base = tmp_dir.rstrip("/") + "/"
    df = spark.createDataFrame([(1, 0, 0, "/a", False)], schemas.FILE_STATUS).coalesce(1)
    _commit(spark, base, "2017-09-17", 1505661514000, df)
    _commit(spark, base, "2017-09-18", 1505747914000, df, attempt_only=True)  # cut off before it was moved
    df.write.parquet(f"{base}aggregator/2017-09-18/latest/file_status")  # no run: it has no record
    df.write.parquet(f"{base}aggregator/2017-09-19/1505834314000/file_status")
    runs = {(r.day, r.run_ts, r.kind, r.n_files) for r in catalog_runs(spark, base).collect()}
    assert runs == {(day, ts, kind, 1) for day, ts in (("2017-09-17", 1505661514000), ("2017-09-18", 1505747914000))
                    for kind in ("file_status", "file_meta")}
    for day, ts in (("2017-09-17", 1505661514000), ("2017-09-18", 1505747914000)):
        assert read_run_file_status(spark, base, f"aggregator/{day}/{ts}/file_status").count() == 1
        assert read_commit(spark, f"{base}aggregator/{day}/{ts}") == {"rows": 1}


def test_a_killed_run_leaves_the_old_one_readable(spark, tmp_dir, monkeypatch):
    import pytest

    from blobtally.plans import layout, sinks

    raw, blobs, index = _store_of_files(spark, tmp_dir)
    base = tmp_dir.rstrip("/") + "/"
    sub = "aggregator/2017-09-17/1505661514000/"

    def run(objects):
        return jobs.run_aggregate(spark, objects, blobs, index, None, base, WHEN, archive_bucket="archive")

    def seen():
        return (sorted(r.file_id for r in read_run_file_status(spark, base, sub + "file_status").collect()),
                sorted(r.objectKey for r in read_run_file_meta(spark, base, sub + "file_meta").collect()))

    with monkeypatch.context() as m:  # the very first run dies between its two writes: there is no run
        m.setattr(sinks, "write_file_meta", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            run(raw)
    assert catalog_runs(spark, base).count() == 0
    with pytest.raises(FileNotFoundError):
        read_run_file_status(spark, base, sub + "file_status")
    assert run(raw).exit_code == 0
    old = seen()
    assert old == ([1, 2, 6], ["photos/1", "photos/2"])
    less = raw.where("decode(uri, 'UTF-8') = 'u1'")
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_file_meta", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            run(less)
    assert seen() == old
    with monkeypatch.context() as m:  # publishing fails: the exit code says so, the old run stays
        m.setattr(layout.Publication, "commit", lambda *a: (_ for _ in ()).throw(OSError("no rename")))
        res = run(less)
    assert (res.exit_code, res.error) == (-1, "no rename") and seen() == old
    settle = layout.Publication.settle

    def half(self):  # killed after the first of the two moves
        fs, at = layout._fs(self.spark, self.run_dir)
        fs.delete(at(f"{self.run_dir}/file_status"), True)
        fs.rename(at(self.staged("file_status")), at(f"{self.run_dir}/file_status"))
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(layout.Publication, "settle", half)
        with pytest.raises(KeyboardInterrupt):
            run(less)
    assert seen() == ([1], ["photos/1"])  # committed, so both outputs are the new ones
    assert run(raw).exit_code == 0 and seen() == old and layout.Publication.settle is settle


def test_sample_input_files_with_a_space_in_the_path(spark, tmp_dir):
    from blobtally.sources import read_objects, sample_input_files

    path = os.path.join(tmp_dir, "obj table")
    spark.createDataFrame([(b"k", b"u", (1).to_bytes(8, "big"))], schemas.RAW_OBJECTS).write.parquet(path)
    files, ratio = sample_input_files(spark, path, schemas.RAW_OBJECTS, 1.0)
    assert ratio == 1.0 and read_objects(spark, files).count() == 1


def test_custom_key_delimiter_through_both_jobs(spark, fx, tmp_dir):
    inputs = _write_inputs(fx, tmp_dir)
    base = tmp_dir.rstrip("/") + "/"
    res = jobs.run_aggregate(spark, inputs["objects_raw"], inputs["blob_index"], inputs["file_index"],
                             inputs["file_lengths"], base, WHEN, archive_bucket="archive", key_delimiter="#")
    sub = res.status_path[len(base):]
    comp = jobs.run_compact(spark, base, sub, os.path.join(tmp_dir, "plan"), max_bytes=4194304, files_per_group=16,
                            meta_sub_path=res.meta_path[len(base):], key_delimiter="#")
    reloc = spark.read.parquet(comp.relocation_path)
    assert reloc.count() == spark.read.parquet(res.meta_path).select("meatRowKey").distinct().count()


def test_run_paths_naive_and_truncation():
    from blobtally.plans.layout import run_paths

    aware = datetime(2017, 9, 17, 23, 59, 59, 999600, tzinfo=timezone.utc)
    p = run_paths("/b/", aware)
    assert (p.day, p.millis) == ("2017-09-17", 1505692799999)
    naive = datetime(2017, 9, 17, 12, 0, 0)
    assert run_paths("/b/", naive).millis == run_paths("/b/", naive.astimezone(timezone.utc)).millis


def test_catalog_runs_of_an_empty_base(spark, tmp_dir):
    runs = catalog_runs(spark, tmp_dir.rstrip("/") + "/nothing-here/")
    assert runs.columns == ["run_dir", "kind", "day", "run_ts", "n_files"] and runs.count() == 0


def _store_of_files(spark, root):
    """Five blob files: one stored, one empty, one gone, one without entry, one without path; one archived and gone."""
    store = os.path.join(root, "store")
    os.makedirs(store)
    for name, size in [("f1", 1000), ("f2", 0)]:
        with open(os.path.join(store, name), "wb") as fh:
            fh.write(b"x" * size)
    objects = [(f"photos/{i}", f"u{i}") for i in range(1, 6)] + [("archive/6", "u6")]
    raw = spark.createDataFrame([(k.encode(), u.encode(), (7).to_bytes(8, "big")) for k, u in objects],
                                schemas.RAW_OBJECTS)
    blobs = spark.createDataFrame([(f"u{i}", i, f"b{i}", 0, 100) for i in range(1, 7)], schemas.BLOB_INDEX)
    index = spark.createDataFrame([(i, None if i == 5 else f"{store}/f{i}") for i in (1, 2, 3, 5, 6)], schemas.FILE_INDEX)
    return raw, blobs, index


def test_aggregate_looks_lengths_up_in_the_store(spark, tmp_dir):
    raw, blobs, index = _store_of_files(spark, tmp_dir)
    res = jobs.run_aggregate(spark, raw, blobs, index, None, tmp_dir.rstrip("/") + "/", WHEN, archive_bucket="archive")
    got = {r.file_id: (r.emptyPercent, r.remainSize) for r in read_file_status(spark, res.status_path).collect()}
    # The archived file needs no length, so it stays although it is gone.
    assert got == {1: (90, 100), 2: (-1, 100), 6: (schemas.ARCHIVED_EMPTY_PERCENT, schemas.LONG_MAX)}
    assert res.counters == {"hits": 6, "misses": 0, "files": 3, "files_no_entry": 1, "files_no_path": 1,
                            "files_no_length": 1}


def test_null_keys_in_the_lookup_sources_pass(spark, tmp_dir):
    raw, blobs, index = _store_of_files(spark, tmp_dir)
    nulls = spark.createDataFrame([(None, "/x"), (None, "/y")], "file_id bigint, path string")
    none = spark.createDataFrame([(None, 1, "b", 0, 1)] * 2, "uri string, file_id bigint, blob_id string, start bigint, length bigint")
    res = jobs.run_aggregate(spark, raw, blobs.unionByName(none), index.unionByName(nulls), None, tmp_dir.rstrip("/") + "/", WHEN,
                             archive_bucket="archive")
    assert res.exit_code == 0 and res.counters["files"] == 3


def test_hot_uris_and_sampled_references_through_the_job(spark, tmp_dir):
    raw, blobs, index = _store_of_files(spark, tmp_dir)
    more = spark.range(200).selectExpr("encode(concat('photos/h', id), 'UTF-8') AS row_key", "encode('u1,u2', 'UTF-8') AS uri",
                                       "unhex('0000000000000007') AS size")
    def run(base, **given):
        res = jobs.run_aggregate(spark, raw.unionByName(more), blobs, index, None, f"{tmp_dir}/{base}/", WHEN, archive_bucket="archive", **given)
        st = {r.file_id: r.remainSize for r in read_file_status(spark, res.status_path).collect()}
        meta = sorted(map(tuple, spark.read.parquet(res.meta_path).collect()))
        return res, st, meta
    _, st, meta = run("plain", skew_rows=None)
    _, hot_st, hot_meta = run("hot", skew_rows=100)
    assert (st, meta) == (hot_st, hot_meta) and len(meta) == 402
    res, thin_st, thin_meta = run("thin", ref_fraction=0.25, skew_rows=100)
    assert res.counters["hits"] == 406  # lookups are counted before the sample
    per_file = {i: 100 * sum(m[0].startswith(f"{i}_") for m in thin_meta) for i in (1, 2)}
    assert 20 < len(thin_meta) < 190 and {k: v for k, v in thin_st.items() if k in (1, 2)} == per_file


def test_aggregate_counts_dropped_files_with_a_length_table(spark, tmp_dir):
    raw, blobs, index = _store_of_files(spark, tmp_dir)
    lengths = index.filter("file_id <= 2").selectExpr("path", "1000L AS length")
    res = jobs.run_aggregate(spark, raw, blobs, index, lengths, tmp_dir.rstrip("/") + "/", WHEN,
                             archive_bucket="archive")
    assert {k: v for k, v in res.counters.items() if k.startswith("files")} == \
        {"files": 3, "files_no_entry": 1, "files_no_path": 1, "files_no_length": 1}


def test_paths_without_scheme_belong_to_the_default_filesystem(spark, tmp_dir):
    import pytest

    here = os.path.join(tmp_dir, "a#b?c")
    with open(here, "wb") as fh:
        fh.write(b"xyz")
    paths = spark.createDataFrame([(here,), (None,)], "path string")
    assert {r.path: r.length for r in stat_file_lengths(paths, default_fs="file:///").collect()} == {here: 3, None: None}
    # A local file of that name is no answer where the default filesystem is another one.
    with pytest.raises(Exception):
        stat_file_lengths(paths, default_fs="nosuchfs://nn:8020").collect()


def test_stat_passes_rows_through_unchanged(spark):
    from blobtally.sources import with_stat_lengths

    rows = [(9007199254740993, None, True), (None, "/no/such/file", True), (1, "/etc/hostname", False)]
    df = spark.createDataFrame(rows, "n bigint, path string, ask boolean")
    got = sorted(map(tuple, with_stat_lengths(df, wanted="ask").collect()), key=str)
    assert got == sorted([(*r, None) for r in rows], key=str)
    assert with_stat_lengths(df.limit(0)).count() == 0
