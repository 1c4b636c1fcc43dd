"""Listing of a folder tree by tasks: folders are expanded round by round, nothing per file on the driver."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobtally.session import materialise
from blobtally.sources.tables import default_filesystem

_LISTED = "path string, length bigint, is_dir boolean"


def _lister(default_fs: str):
    """Arrow function: the entries of the given folders. Nested, so it is shipped by value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import urlparse

        import pyarrow as pa
        from pyarrow import fs as pafs

        clients: dict = {}
        home = urlparse(default_fs)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                u = urlparse(folder)
                scheme, netloc, path = (u.scheme, u.netloc, u.path) if u.scheme else (home.scheme, home.netloc, folder)
                shown = f"{u.scheme}://{u.netloc}" if u.scheme and (u.netloc or u.scheme != "file") else f"{u.scheme}:" if u.scheme else ""
                if scheme in ("", "file"):
                    scheme, netloc = "file", ""
                elif scheme not in ("hdfs", "viewfs"):  # object stores keep the bucket in front of the path
                    path, shown = netloc + path, f"{u.scheme}://"
                if (scheme, netloc) not in clients:
                    uri = f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{netloc}/"
                    clients[scheme, netloc] = pafs.LocalFileSystem() if scheme == "file" else pafs.FileSystem.from_uri(uri)[0]
                found = clients[scheme, netloc].get_file_info(pafs.FileSelector(path, allow_not_found=True))
                found = [f for f in found if f.type != pafs.FileType.NotFound]
                for at in range(0, len(found), 10_000):
                    some = found[at:at + 10_000]
                    dirs = [f.type == pafs.FileType.Directory for f in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shown + f.path for f in some], pa.string()),
                         pa.array([None if d else f.size for f, d in zip(some, dirs)], pa.int64()), pa.array(dirs)],
                        names=["path", "length", "is_dir"])

    return run


def list_tree(spark: SparkSession, root: str, default_fs: str | None = None) -> DataFrame:
    """Every file below ``root``: path and length (bigint), empty files included (SRC4, SNK7).

    Each round lists the folders that the round before found, one listing call for each folder, dealt over
    the shuffle partitions; the rounds are as many as the tree is deep. A task holds one folder's
    entries. A missing root gives an empty result. Paths keep the form of ``root`` (with or without scheme).
    """
    home = default_fs or default_filesystem(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    found, n = [], 1
    while n:
        listed = materialise(folders.repartition(min(n, parts), "path").mapInArrow(_lister(home), _LISTED), "listing")
        found.append(listed.where(~F.col("is_dir")).select("path", "length"))
        folders = listed.where("is_dir").select("path")
        n = folders.count()
    return reduce(DataFrame.unionByName, found)
