"""What op3 keeps on disk, and its rewritten steps against the plain ones."""

import os

import numpy as np
from pyspark.sql import functions as F

from blobtally.llm import common
from blobtally.llm import compact_windows as cw


def shuffle_files(spark):
    """Files of shuffles that the block manager holds now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), shuffle_files(spark)
    out = common.materialise(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffle_files(spark) <= before
    assert spark.conf.get(key) == setting
    assert sorted(r["count"] for r in out.collect()) == [714] * 5 + [715] * 2


def test_window_tables_go_when_nothing_reads_them(make_docs, prose):
    shared = prose(900, 60)
    docs = make_docs([(i, f"{prose(i, 80)} {shared if i % 2 else prose(900, 20)} {prose(500 + i, 70)}") for i in range(40)])
    with common.collect_tables() as tables:
        out = cw.repeated_passages(docs)
        left = [os.path.basename(t).rsplit("-", 1)[0] for t in tables if os.path.isdir(t.removeprefix("file:"))]
        made = [os.path.basename(t).rsplit("-", 1)[0] for t in tables]
    assert "window_pairs" in made and "open_sides" in made
    assert "window_pairs" not in left and "open_sides" not in left and "passages" in left
    assert out.count() == 19


def test_rows_are_paired_with_the_first_of_their_slot(spark):
    rng = np.random.default_rng(5)
    rows = {(int(s), int(u), int(a)) for s, u, a in rng.integers(0, 12, (300, 3))}
    known = (99, 3, 4, 5, {"uid": 1, "at": 2, "reach": 3, "key": 7})
    df = spark.createDataFrame([(s, u, a, s + u + a, None) for s, u, a in rows] + [known], cw._ROW)
    want = {(3, 4, 5, 1, 2, 3, 7)}
    for s, u, a in rows:
        _, fu, fa = min(x for x in rows if x[0] == s)
        if (u, a) != (fu, fa):
            want.add((u, a, s + u + a, fu, fa, s + fu + fa, s))
    got = [tuple(r) for r in cw._paired(df).collect()]
    assert len(got) == len(want) and set(got) == want


def test_shingles_of_documents_in_a_row():
    rng = np.random.default_rng(6)
    docs = [[b"w%d" % i for i in rng.integers(0, 9, n)] for n in (5, 60, 6, 7, 200)]
    x, starts, barrier = cw._in_a_row([cw._word_hashes(d) for d in docs])
    for d, s in zip(docs, starts):
        h = cw.shingle_hashes(d)
        assert np.array_equal(x[s:s + len(h)], h) and not barrier[s:s + len(h)].any()
        assert barrier[s - 1] and barrier[s + len(h)]
    assert barrier.sum() == len(docs) + 1 and len(x) == sum(len(d) - 4 for d in docs) + len(docs) + 1


def test_words_are_counted_for_copies_only(make_docs, prose):
    """A filter by the number of words must not be moved to all texts."""
    docs = make_docs([(i, prose(i // 2, 80)) for i in range(20)])
    plans, write = [], cw.materialise

    def seen(df, name):
        if name == "passages":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    cw.materialise = seen
    try:
        assert cw.repeated_passages(docs).count() == 10
    finally:
        cw.materialise = write
    filters = [line for line in plans[0].splitlines() if "Filter" in line]
    assert not any("split(" in line for line in filters)
