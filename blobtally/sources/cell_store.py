"""Writes of key-value cells that count once, whatever is retried (SNK8, SNK9).

A store hands every task attempt a writer of its own; what an attempt wrote counts only once the driver
publishes it, from the commit messages of the attempts that Spark accepted. A retried or speculative
attempt, or one whose executor was lost, is never published.

``DirectoryCellStore`` keeps cells as Parquet files under a folder, with a manifest of each publication:
its files, their regions, cell counts and first and last keys. Readers take published files only.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

KEY = ("row_key", "family", "qualifier")
MANIFEST = pa.schema([("file", pa.string()), ("region", pa.int64()), ("n_cells", pa.int64()),
                      *[(f"first_{c}", pa.binary()) for c in KEY], *[(f"last_{c}", pa.binary()) for c in KEY]])


class CellWriter(Protocol):
    """What one task attempt writes to."""

    def write(self, batch: pa.RecordBatch) -> None: ...

    def close(self) -> list[dict]:
        """Finish, and describe what was written (anything that pickles; it goes to ``publish``)."""


class CellStore(Protocol):
    def open(self, attempt: str) -> CellWriter: ...

    def publish(self, written: list[tuple[str, list[dict]]]) -> None:
        """Make the given attempts' cells visible, all or none; called once, on the driver."""

    def discard(self, attempts: list[str]) -> None: ...


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    n: int
    entries: list = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, store: CellStore):
        self.store = store

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        attempt = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        writer, n = self.store.open(attempt), 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    writer.write(batch)
                    n += batch.num_rows
            return Written(attempt, n, writer.close())
        except BaseException:
            self.store.discard([attempt])
            raise

    def commit(self, messages: list[Written | None]) -> None:
        self.store.publish([(m.attempt, m.entries) for m in messages if m is not None])

    def abort(self, messages: list[Written | None]) -> None:
        self.store.discard([m.attempt for m in messages if m is not None])


def put_cells(cells: DataFrame, store: CellStore) -> None:
    """SNK8: write cells by calls on a store, through a data source whose tasks commit or abort.

    Every cell is published once although tasks may run more than once. A failed run publishes nothing.
    """
    class Cells(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite) -> _Writer:
            return _Writer(store)

    name = f"cells_{uuid.uuid4().hex[:8]}"
    cells.sparkSession.dataSource.register(Cells)
    cells.write.format(name).mode("append").save()


def local_path(path: str) -> str:
    """The path of a ``file:`` URI; any other path as it is."""
    return re.sub(r"^file:(//)?(?=/)", "", path)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    path = local_path(path)
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


class _Files:
    """Parquet files of one attempt, a new one where the region changes; entries for the manifest."""

    def __init__(self, fs: pafs.FileSystem, folder: str, attempt: str):
        self.fs, self.folder, self.attempt = fs, folder, attempt
        self.entries: list[dict] = []
        self.open_ = None

    def write(self, batch: pa.RecordBatch) -> None:
        if "region" not in batch.schema.names:
            self._append(None, batch)
            return
        region = batch.column("region").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist(), len(region)]
        for a, b in zip(cuts, cuts[1:]):
            self._append(batch.column("region")[a].as_py(), batch.slice(a, b - a).drop_columns(["region"]))

    def _append(self, region: int | None, cells: pa.RecordBatch) -> None:
        first, last = ({c: cells.column(c)[i].as_py() for c in KEY} for i in (0, cells.num_rows - 1))
        if self.open_ is None or self.entries[-1]["region"] != region:
            self._finish()
            name = f"{self.attempt}-{len(self.entries):04d}.parquet"
            self.fs.create_dir(self.folder, recursive=True)
            self.open_ = pq.ParquetWriter(f"{self.folder}/{name}", cells.schema, filesystem=self.fs)
            self.entries.append({"file": name, "region": region, "n_cells": 0, **{f"first_{c}": first[c] for c in KEY}})
        self.open_.write_batch(cells)
        self.entries[-1] |= {"n_cells": self.entries[-1]["n_cells"] + cells.num_rows, **{f"last_{c}": last[c] for c in KEY}}

    def _finish(self) -> None:
        if self.open_ is not None:
            self.open_.close()
            self.open_ = None

    def close(self) -> list[dict]:
        self._finish()
        return self.entries


def overlaps(entries: list[dict]) -> list[tuple[str, str]]:
    """Neighbouring files of sorted cells whose key ranges are not disjoint."""
    def key(e: dict, end: str) -> tuple:
        return tuple(e[f"{end}_{c}"] for c in KEY)

    order = sorted(entries, key=lambda e: (key(e, "first"), key(e, "last")))
    return [(a["file"], b["file"]) for a, b in zip(order, order[1:]) if key(a, "last") >= key(b, "first")]


class DirectoryCellStore:
    """Cells as Parquet files under ``path``: ``attempts/`` until they are published, then ``data/``
    (``data/region=<i>/`` for cells with a region), with one manifest for each publication.

    ``disjoint`` checks, before anything is published, that the files' key ranges do not overlap (sorted
    cells); ``replace`` takes earlier publications away. Publishing holds one entry for each file.
    """

    def __init__(self, path: str, disjoint: bool = False, replace: bool = False):
        self.path, self.disjoint, self.replace = path.rstrip("/"), disjoint, replace
        self.run = uuid.uuid4().hex[:12]

    def open(self, attempt: str) -> CellWriter:
        fs, root = _filesystem(self.path)
        return _Files(fs, f"{root}/attempts/{self.run}/{attempt}", attempt)

    def publish(self, written: list[tuple[str, list[dict]]]) -> None:
        fs, root = _filesystem(self.path)
        entries = [e for _, some in written for e in some]
        if self.disjoint and (bad := overlaps(entries)):
            self.discard([a for a, _ in written])
            raise ValueError(f"key ranges of files overlap: {bad[:3]}")
        if self.replace:
            for old in ("manifests", "data"):
                if fs.get_file_info(f"{root}/{old}").type != pafs.FileType.NotFound:
                    fs.delete_dir(f"{root}/{old}")
        fs.create_dir(f"{root}/data", recursive=True)
        for attempt, some in written:
            for e in some:
                folder = f"{root}/data" if e["region"] is None else f"{root}/data/region={e['region']}"
                fs.create_dir(folder, recursive=True)
                fs.move(f"{root}/attempts/{self.run}/{attempt}/{e['file']}", f"{folder}/{self.run}-{e['file']}")
        named = [e | {"file": f"{self.run}-{e['file']}"} for e in entries]
        fs.create_dir(f"{root}/manifests", recursive=True)
        pq.write_table(pa.Table.from_pylist(named, schema=MANIFEST), f"{root}/attempts-{self.run}.parquet", filesystem=fs)
        # The move is what publishes: a reader sees the whole manifest or none of it.
        fs.move(f"{root}/attempts-{self.run}.parquet", f"{root}/manifests/{self.run}.parquet")
        self.discard([a for a, _ in written])

    def discard(self, attempts: list[str]) -> None:
        fs, root = _filesystem(self.path)
        for a in attempts:
            folder = f"{root}/attempts/{self.run}/{a}"
            if fs.get_file_info(folder).type != pafs.FileType.NotFound:
                fs.delete_dir(folder)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Published files of a ``DirectoryCellStore``: file, region, n_cells, first and last key."""
    return spark.read.parquet(f"{path.rstrip('/')}/manifests")


def read_cell_store(spark: SparkSession, path: str) -> DataFrame:
    """Published cells, with the file that holds each; files without a manifest entry are left out."""
    data = spark.read.parquet(f"{path.rstrip('/')}/data")
    named = data.select("*", F.col("_metadata.file_name").alias("file"))
    return named.join(read_manifest(spark, path).select("file"), "file", "left_semi")
