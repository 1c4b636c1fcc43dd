"""Hand-made rows for every branch of reference handling and per-file status."""

from pyspark.sql import functions as F

from blobtally import schemas
from blobtally.operators import joins, refs, status

L = 1 << 20  # a length unit


def raw(spark, rows):
    enc = []
    for key, uri, size in rows:
        size_b = size if isinstance(size, (bytes, type(None))) else int(size).to_bytes(8, "big", signed=True)
        enc.append((key.encode(), None if uri is None else uri.encode(), size_b))
    return spark.createDataFrame(enc, schemas.RAW_OBJECTS)


def index(spark, rows):
    return spark.createDataFrame(rows, schemas.BLOB_INDEX)


def test_object_refs_filters_and_bag_semantics(spark):
    df = raw(spark, [
        ("photos/a", "u1,u1,,u2,", 10),      # same uri twice counts twice; empty tokens dropped
        ("photos/b", " ", 5),                # whitespace token is not trimmed, so it passes
        ("photos/c", "u3", 0),               # size 0 dropped after explode
        ("photos/d", "u4", -2),              # negative size passes
        ("photos/e", None, 4),               # null uri
        ("photos/f", "", 4),                 # empty uri
        ("photos/g", "u5", None),            # null size
        ("photos/h", "u6", b""),             # empty size cell
    ])
    got = sorted(tuple(r) for r in refs.object_refs(df).collect())
    assert got == sorted([("photos/a", "u1", 10), ("photos/a", "u1", 10), ("photos/a", "u2", 10),
                          ("photos/b", " ", 5), ("photos/d", "u4", -2)])


def test_lookup_counters_add_up(spark):
    r = refs.object_refs(raw(spark, [("p/a", "u1,u2,zz", 3), ("p/b", "u1,yy", 3)]))
    idx = index(spark, [("u1", 1, "b1", 0, L), ("u2", 1, "b2", L, L)])
    c = refs.lookup_counters(r, idx).first()
    assert (c.hits, c.misses) == (3, 2)
    assert refs.ref_count(r, idx).first().ref_count == 3
    assert sorted(x.uri for x in refs.unresolved_refs(r, idx).collect()) == ["yy", "zz"]
    assert refs.resolve_refs(r, idx).count() == 3


def test_lookup_join_hot_key_split_equals_plain_join(spark):
    import pytest

    facts = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("uri"), F.col("id"))
    idx = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "uri string, file_id long")
    assert joins.find_hot_keys(facts, "uri", skew_rows=500) == ["hot"]
    assert set(joins.find_hot_keys(facts, "uri", skew_rows=38)) == {"hot"} | {f"k{i}" for i in range(50) if i != 1}
    for hot in (["hot"], ["hot", "k7", "nobody", None, "hot"], [f"k{i}" for i in range(50)] + ["hot"]):
        for how in ["inner", "left", "left_anti", "left_semi"]:
            plain = sorted(map(tuple, facts.join(idx, "uri", how).collect()), key=str)
            split = sorted(map(tuple, joins.lookup_join(facts, idx, "uri", how, hot_keys=hot).collect()), key=str)
            assert plain == split, how
    found = joins.lookup_join(facts, idx, "uri", skew_rows=500)
    assert found.count() == facts.join(idx, "uri").count()
    with pytest.raises(ValueError, match="bound"):
        joins.lookup_join(facts, idx, "uri", hot_keys=[str(i) for i in range(joins.HOT_KEYS + 1)])


def test_the_sketch_keeps_every_heavy_key(spark):
    """Many light keys beside heavy ones, over several partitions: no heavy key is lost."""
    facts = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("h"), (F.col("id") % 40).cast("string"))).otherwise(F.col("id").cast("string")).alias("uri"))
    assert sorted(joins.find_hot_keys(facts, "uri", skew_rows=4000)) == sorted(f"h{i}" for i in range(0, 40, 4))


def test_sample_refs(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "file_id").withColumn("start", F.lit(0))
    assert refs.sample_refs(df, 1.0).count() == 2000
    keyed = refs.sample_refs(df, 0.25, key=refs.blob_sample_key())
    assert keyed.count() == 500
    bern = refs.sample_refs(df, 0.1, seed=5).count()
    assert 100 < bern < 320


def test_nest_flatten_roundtrip(spark):
    r = refs.object_refs(raw(spark, [("p/a", "u1", 3)]))
    res = refs.resolve_refs(r, index(spark, [("u1", 7, "b1", 5, 9)]))
    nested = refs.nest_refs(res)
    assert nested.schema["blob_info"].dataType.simpleString() == \
        "struct<file_id:bigint,blob_id:string,start:bigint,length:bigint>"
    assert tuple(refs.flatten_refs(nested).first()) == ("p/a", 3, 7, "b1", 5, 9)


def _status(spark, objects, blobs, files, lengths):
    r = refs.object_refs(raw(spark, objects))
    st = status.file_status(r, index(spark, blobs),
                            spark.createDataFrame(files, schemas.FILE_INDEX),
                            spark.createDataFrame(lengths, schemas.FILE_LENGTHS), "archive")
    return {row.file_id: tuple(row)[1:] for row in st.collect()}, r


def test_file_status_branches(spark):
    objects = [
        ("archive/a", "f1a", 1),              # file 1: all archived
        ("archive/b", "f1b,f2a", 1),          # file 2 gets one archived and one live ref
        ("photos/c", "f2a", 1),
        ("photos/d", "f3a", 1),               # file 3: zero stored length
        ("photos/e", "f4a,f4a", 1),           # file 4: referenced twice -> negative percent
        ("photos/f", "f5a", 1),               # file 5: no length -> dropped
        ("photos/g", "f6a", 1),               # file 6: null path -> dropped
        ("photos/h", "f7a", 1),               # file 7: not in file index -> dropped
        ("archive/i", "f8a", 1),              # file 8: all archived, no length -> kept
        ("photos/j", "f9a", 1), ("photos/k", "f9a", 1),  # file 9: two objects share one blob
    ]
    blobs = [("f1a", 1, "a", 0, L), ("f1b", 1, "b", L, L), ("f2a", 2, "a", 0, 3 * L),
             ("f3a", 3, "a", 0, L), ("f4a", 4, "a", 0, 2 * L), ("f5a", 5, "a", 0, L),
             ("f6a", 6, "a", 0, L), ("f7a", 7, "a", 0, L), ("f8a", 8, "a", 0, L), ("f9a", 9, "a", 0, L)]
    files = [(i, None if i == 6 else f"/f{i}") for i in [1, 2, 3, 4, 5, 6, 8, 9]]
    lengths = [("/f1", 0), ("/f2", 7 * L), ("/f3", 0), ("/f4", 3 * L), ("/f6", L), ("/f9", 4 * L)]
    got, r = _status(spark, objects, blobs, files, lengths)
    m = schemas.LONG_MAX
    assert got == {
        1: (-1, m, "/f1", False),
        2: (57, 3 * L, "/f2", False),            # (7-3)*100 div 7 = 57
        3: (-1, L, "/f3", False),                # zero length
        4: (-33, 4 * L, "/f4", False),           # (3-4)*100 div 3 = -33 (toward zero)
        8: (-1, m, "/f8", False),
        9: (50, 2 * L, "/f9", False),
    }
    # Meta: live references of surviving files only; none for all-archived files.
    st = spark.createDataFrame([(k, *v) for k, v in got.items()], schemas.FILE_STATUS)
    meta = status.file_meta(r, index(spark, blobs), st, "archive").collect()
    keys = sorted(x.meatRowKey for x in meta)
    assert keys == ["2_a", "3_a", "4_a", "4_a", "9_a", "9_a"]
    lists = {x.file_id: (x.n_meta, x.meta_length) for x in status.file_meta_lists(
        spark.createDataFrame(meta, schemas.FILE_META)).collect()}
    assert lists == {2: (1, 3 * L), 3: (1, L), 4: (2, 4 * L), 9: (2, 2 * L)}


def test_meta_sums_equal_remain_size_on_fixture(spark, fx):
    r = refs.object_refs(fx.objects_raw)
    st = status.file_status(r, fx.blob_index, fx.file_index, fx.file_lengths, "archive")
    meta = status.file_meta(r, fx.blob_index, st, "archive")
    lists = status.file_meta_lists(meta)
    live = st.filter(F.col("remainSize") != schemas.LONG_MAX)
    j = live.join(lists, "file_id", "left")
    bad = j.filter(F.coalesce(F.col("meta_length"), F.lit(0)) != F.col("remainSize")).count()
    assert bad == 0
    # All-archived files have no meta rows.
    archived = st.filter(F.col("remainSize") == schemas.LONG_MAX).select("file_id")
    assert lists.join(archived, "file_id").count() == 0


def test_flatten_meta_is_clustered_by_file(spark, fx):
    r = refs.object_refs(fx.objects_raw)
    st = status.file_status(r, fx.blob_index, fx.file_index, fx.file_lengths, "archive")
    flat = status.flatten_meta(status.file_meta(r, fx.blob_index, st, "archive"), num_partitions=4)
    rows = flat.collect()
    order = [(int(x.meatRowKey.split("_")[0]), x.start, x.meatRowKey) for x in rows]
    assert order == sorted(order)


def test_hot_keys_from_file_sample(spark, tmp_dir):
    from blobtally import schemas as sc
    from blobtally.sources import read_objects, sample_input_files

    rows = [(f"photos/{i}".encode(), (b"hot," + f"u{i}".encode()), (8).to_bytes(8, "big")) for i in range(4000)]
    path = tmp_dir + "/objects"
    spark.createDataFrame(rows, sc.RAW_OBJECTS).repartition(20).write.parquet(path)
    files, ratio = sample_input_files(spark, path, sc.RAW_OBJECTS, 0.2, seed=1)
    assert 0 < len(files) < 20 and abs(ratio - len(files) / 20) < 1e-9
    again, _ = sample_input_files(spark, path, sc.RAW_OBJECTS, 0.2, seed=1)
    assert again == files
    hot = joins.find_hot_keys(refs.object_refs(read_objects(spark, files)), "uri", 1000, presampled=ratio)
    assert hot == ["hot"]


def test_remain_size_beyond_long_fails(spark):
    import pytest

    big = (1 << 62)
    objects = [("photos/a", "h", 1), ("photos/b", "h", 1), ("photos/c", "h", 1), ("photos/d", "s", 1)]
    r = refs.object_refs(raw(spark, objects))
    with pytest.raises(Exception, match="remaining bytes exceed"):
        status.file_totals(r, index(spark, [("h", 1, "a", 0, big), ("s", 2, "a", 0, 10)]), "archive").collect()


def test_repeated_lookup_keys_fail_the_run(spark, fx):
    import pytest

    once = joins.unique_rows(fx.blob_index, "uri")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, fx.blob_index.select(*once.columns).collect()))
    for df, key in ((fx.blob_index, "uri"), (fx.file_index, "file_id"), (fx.file_lengths, "path")):
        with pytest.raises(Exception, match="is not unique in the index"):
            joins.unique_rows(df.union(df.limit(1)), key).agg(F.count("*")).collect()


def test_null_keys_are_no_repeats(spark):
    idx = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "file_id bigint, path string")
    assert [tuple(r) for r in joins.unique_rows(idx, "file_id").collect()] == [(1, "c")]
    assert joins.assert_unique(idx, "file_id") is idx


def test_reference_sample(spark):
    import pytest

    r = refs.object_refs(raw(spark, [(f"photos/{i}", "u1,u1,u2", 1) for i in range(3000)]), numbered=True)
    for f in (0.0, 0.001, 0.25, 1 / 3):
        marked = refs.mark_sample(r, f)
        n = marked.filter("kept").count()
        assert abs(n - 9000 * f) <= 4 * (9000 * f * (1 - f)) ** 0.5 + 1e-9
        by_md5 = refs.mark_sample(r, f, F.md5(F.concat_ws("|", "object_key", "ref_no", "uri"))).filter("kept").count()
        assert abs(by_md5 - 9000 * f) <= 4 * (9000 * f * (1 - f)) ** 0.5 + 1e-9
    assert refs.mark_sample(r, 1.0).filter("kept").count() == 9000
    with pytest.raises(ValueError):
        refs.mark_sample(r, 1.5)
    # The two references of an object to one blob are sampled apart; status and meta keep the same ones.
    marked = refs.mark_sample(r, 0.3)
    idx = index(spark, [("u1", 1, "a", 0, 10), ("u2", 2, "b", 10, 10)])
    totals = {x.file_id: (x.n_refs, x.n_live, x.remain_size) for x in status.file_totals(marked, idx, "archive").collect()}
    kept = marked.filter("kept").groupBy("uri").count().collect()
    want = {1 if x.uri == "u1" else 2: (x["count"], x["count"], 10 * x["count"]) for x in kept}
    assert totals == want
    one = marked.filter("kept").filter("uri = 'u1'").groupBy("object_key").count().filter("count = 1").count()
    assert one > 0
    st = spark.createDataFrame([(1, 0, 0, "/a", False), (2, 0, 0, "/b", False)], schemas.FILE_STATUS)
    meta = status.file_meta(marked, idx, st, "archive").groupBy("meatRowKey").count().collect()
    assert {int(m.meatRowKey[0]): m["count"] for m in meta} == {k: v[0] for k, v in want.items()}


def test_meta_lists_are_bounded_and_flatten_back(spark):
    rows = [(f"1_b{i:04d}", f"o{i % 3}", i * 10, 10) for i in range(250)] + [("2_x", "o", None, 1), ("2_x", "o", None, 1), ("3_y", "o", 0, 1)]
    meta = spark.createDataFrame(rows, schemas.FILE_META).repartition(5)
    lists = status.meta_lists(meta, max_rows=100)
    got = {(x.file_id, x.list_no): x.rows for x in lists.collect()}
    assert {k: len(v) for k, v in got.items()} == {(1, 0): 100, (1, 1): 100, (1, 2): 50, (2, 0): 2, (3, 0): 1}
    assert [tuple(x) for k in ((1, 0), (1, 1), (1, 2)) for x in got[k]] == rows[:250]
    flat = status.flatten_lists(lists)
    assert flat.columns == ["file_id", "list_no", "place", *schemas.META_COLUMNS]
    assert sorted(map(tuple, flat.select(*schemas.META_COLUMNS).collect()), key=str) == sorted(rows, key=str)
    assert {(x.file_id, x.list_no, x.place) for x in flat.collect()} == {(*k, i) for k, v in got.items() for i in range(len(v))}
    assert status.meta_lists(meta.limit(0)).count() == 0


def test_assert_unique(spark, fx):
    import pytest

    assert joins.assert_unique(fx.blob_index, "uri") is fx.blob_index
    dup = index(spark, [("u1", 1, "a", 0, 1), ("u1", 2, "b", 0, 1), ("u2", 1, "c", 0, 1)])
    with pytest.raises(ValueError, match="u1"):
        joins.assert_unique(dup, "uri")


def test_file_meta_with_a_hot_uri_equals_plain_lookup(spark):
    # One uri referenced by a third of all objects.
    objects = [(f"photos/{i}", "hot" if i % 3 == 0 else f"u{i % 40}", 1) for i in range(900)]
    blobs = [("hot", 1, "h", 0, 10)] + [(f"u{j}", 2 + j % 5, f"b{j}", j * 10, 10) for j in range(40)]
    r = refs.object_refs(raw(spark, objects))
    idx = index(spark, blobs)
    st = spark.createDataFrame([(f, 0, 0, f"/f{f}", False) for f in range(1, 7)], schemas.FILE_STATUS)
    assert joins.find_hot_keys(r, "uri", skew_rows=200) == ["hot"]
    plain = sorted(map(tuple, status.file_meta(r, idx, st, "archive").collect()))
    split = sorted(map(tuple, status.file_meta(r, idx, st, "archive", hot_keys=["hot"]).collect()))
    found = sorted(map(tuple, status.file_meta(r, idx, st, "archive", skew_rows=200).collect()))
    assert plain == split == found
    assert sum(1 for m in plain if m[0] == "1_h") == 300


def test_null_length_is_zero_bytes_not_overflow(spark):
    r = refs.object_refs(raw(spark, [("photos/1", "u1", 1), ("archive/2", "u2", 1)]))
    idx = index(spark, [("u1", 7, "a", 0, None), ("u2", 7, "b", 0, 50)])
    got = {x.file_id: x.remain_size for x in status.file_totals(r, idx, "archive").collect()}
    assert got == {7: 0}


def test_sampling_granularity_is_checked(spark):
    import pytest

    df = spark.range(0, 10).withColumnRenamed("id", "file_id").withColumn("start", F.lit(0))
    with pytest.raises(ValueError):
        refs.sample_refs(df, 0.001, key=refs.blob_sample_key())
    with pytest.raises(ValueError):
        refs.sample_refs(df, 0.996, key=refs.blob_sample_key())
    with pytest.raises(ValueError):
        refs.blob_sample_filter(1.5)
    blobs = spark.range(0, 20000).select(F.col("id").alias("file_id"), F.lit("b").alias("blob_id"))
    kept = blobs.filter(refs.blob_sample_filter(0.1)).count()
    assert 1600 < kept < 2400
    near_all = blobs.filter(refs.blob_sample_filter(0.9999)).count()
    assert 19_980 < near_all < 20_000


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_references_aggregate_beside_the_index_without_a_join(spark):
    import pytest

    r = refs.mark_sample(spark.createDataFrame(
        [(f"{b}/{i}", i, u, 1) for i, (b, u) in enumerate([("archive", "a"), ("photos", "a"), ("photos", "a"), ("photos", "b"), ("archive", "c"),
                                                          ("photos", "lost")] * 7)], "object_key string, ref_no int, uri string, size bigint"), 0.5)
    idx = index(spark, [("a", 1, "x", 0, 10), ("b", 1, "y", 10, None), ("c", 2, "z", 0, 5), ("unused", 3, "w", 0, 7)])
    idx = idx.unionByName(idx.limit(2).withColumn("uri", F.lit(None).cast("string")))
    for kept in (r, r.drop("kept")):
        for fraction in (1.0, 0.6):
            seen = []
            for co_located in (True, False):
                side = joins.unique_rows(idx, "uri") if co_located else idx
                totals, obs = status.file_totals(kept, side, "archive", observe=True, sample_fraction=fraction, co_located=co_located)
                seen.append((sorted(tuple(x) for x in totals.collect()), obs.get))
            assert seen[0] == seen[1] and seen[0][1] == {"hits": 35, "misses": 7}
    plan = _plan_text(refs.refs_beside_index(r, idx, F.lit(False)))
    assert "Join" not in plan and "Sort" not in plan and plan.count("Exchange hashpartitioning(uri") == 1
    twice = idx.unionByName(index(spark, [("unused", 5, "q", 0, 1)]))  # no reference names it
    with pytest.raises(Exception, match="uri is not unique in the index: unused"):
        status.file_totals(r, twice, "archive", observe=True, co_located=False)[0].collect()


def test_the_job_holds_no_join_by_uri_in_its_status_pass(spark, fx, tmp_dir, monkeypatch):
    from blobtally.plans import jobs, sinks

    plans, write = [], sinks.write_file_status
    monkeypatch.setattr(sinks, "write_file_status", lambda df, path: plans.append(_plan_text(df)) or write(df, path))
    args = (spark, fx.objects_raw, fx.blob_index, fx.file_index, fx.file_lengths)
    done = [jobs.run_aggregate(*args, f"{tmp_dir}/{n}/", archive_bucket="archive", **o) for n, o in (("a", {}), ("b", {"co_located": True}))]
    assert "Join [uri" not in plans[0] and "Join [uri" in plans[1] and done[0].counters == done[1].counters
    rows = [sorted(tuple(x) for x in spark.read.parquet(d.status_path).collect()) for d in done]
    assert rows[0] == rows[1] and rows[0]
