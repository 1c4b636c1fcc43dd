"""Typed readers for every input and output table.

Each reader accepts either a path (read as Parquet with the declared schema, never inferred) or
an existing DataFrame (selected and cast to the declared schema). Selecting by name lets
Catalyst prune every other column at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from blobtally import schemas

Source = str | list | tuple | DataFrame


def _typed(spark: SparkSession, src: Source, schema: StructType) -> DataFrame:
    if isinstance(src, DataFrame):
        df = src
    elif isinstance(src, str):
        df = spark.read.schema(schema).parquet(src)
    elif isinstance(src, (list, tuple)) and src and all(isinstance(p, str) for p in src):
        df = spark.read.schema(schema).parquet(*src)
    else:
        raise TypeError(f"expected a path or a DataFrame, got {type(src).__name__}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_objects(spark: SparkSession, src: Source) -> DataFrame:
    """Raw object table: row_key, uri, size as bytes (SRC1, PRJ1)."""
    return _typed(spark, src, schemas.RAW_OBJECTS)


def read_blob_index(spark: SparkSession, src: Source) -> DataFrame:
    """Blob index: uri -> file_id, blob_id, start, length (SRC2)."""
    return _typed(spark, src, schemas.BLOB_INDEX)


def read_file_index(spark: SparkSession, src: Source) -> DataFrame:
    """File index: file_id -> path (SRC3)."""
    return _typed(spark, src, schemas.FILE_INDEX)


def read_file_lengths(spark: SparkSession, src: Source) -> DataFrame:
    """Pre-listed file lengths: path -> length (SRC4, table form)."""
    return _typed(spark, src, schemas.FILE_LENGTHS)


def list_file_lengths(spark: SparkSession, root: str, strip_scheme: bool = True) -> DataFrame:
    """File lengths straight from the store (SRC4, listing form): every file below ``root``, empty ones too.

    Tasks list the folders (``sources.listing.list_tree``); nothing per file is on the driver.
    ``strip_scheme`` turns ``file:/x`` or ``hdfs://nn/x`` into ``/x`` to match index paths.
    """
    from blobtally.sources.listing import list_tree

    df = list_tree(spark, root)
    if strip_scheme:
        df = df.withColumn("path", F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""))
    return df.select(F.col("path").cast("string"), F.col("length").cast("bigint"))


def _stat_lengths(default_fs: str):
    """Function of a list of paths -> their lengths (null where there is no such file).

    A path without scheme belongs to ``default_fs``. One filesystem client per (scheme, authority)
    per task. HDFS-style paths keep only the path part; object stores keep the bucket in front, as
    pyarrow expects. A filesystem that cannot be reached fails the task. Nested in a function, so
    that it is shipped by value and the executors need pyarrow only.
    """
    def lengths_of(paths: list, clients: dict) -> list:
        from urllib.parse import urlparse

        from pyarrow import fs as pafs

        home = urlparse(default_fs)
        lengths = [None] * len(paths)
        groups = {}
        for i, p in enumerate(paths):
            if p is None:
                continue
            u = urlparse(p)
            # Without a scheme the whole text is the path ('#' and '?' are ordinary characters there).
            scheme, netloc, path = (u.scheme, u.netloc, u.path) if u.scheme else (home.scheme, home.netloc, p)
            if scheme in ("", "file"):
                scheme, netloc = "file", ""
            elif scheme not in ("hdfs", "viewfs"):
                path = netloc + path
            groups.setdefault((scheme, netloc), []).append((i, path))
        for (scheme, netloc), items in groups.items():
            if (scheme, netloc) not in clients:
                uri = f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{netloc}/"
                clients[scheme, netloc] = pafs.LocalFileSystem() if scheme == "file" else pafs.FileSystem.from_uri(uri)[0]
            infos = clients[scheme, netloc].get_file_info([path for _, path in items])
            for (i, _), info in zip(items, infos):
                if info.type == pafs.FileType.File:
                    lengths[i] = info.size
        return lengths

    return lengths_of


def default_filesystem(spark: SparkSession) -> str:
    """The configured default filesystem (``fs.defaultFS``), which paths without scheme belong to."""
    return spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")


def with_stat_lengths(files: DataFrame, path_col: str = "path", wanted: str | None = None,
                      default_fs: str | None = None) -> DataFrame:
    """``files`` with a ``length`` column: one stat per row with a path, batched per task (SRC4).

    Rows whose boolean column ``wanted`` is not true are not looked up. A missing file gets a null
    length, an empty one 0. Rows pass through Arrow unchanged, so there is no join back. Paths
    without scheme belong to ``default_fs`` (by default the session's ``fs.defaultFS``).
    """
    lengths_of = _stat_lengths(default_fs or default_filesystem(files.sparkSession))

    def stat(batches):
        import pyarrow as pa

        clients: dict = {}
        for batch in batches:
            paths = batch.column(path_col).to_pylist()
            if wanted is not None:
                paths = [p if w else None for p, w in zip(paths, batch.column(wanted).to_pylist())]
            sizes = pa.array(lengths_of(paths, clients), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], [*batch.schema.names, "length"])

    return files.mapInArrow(stat, StructType([*files.schema.fields, StructField("length", LongType())]))


def stat_file_lengths(paths: DataFrame, path_col: str = "path", default_fs: str | None = None) -> DataFrame:
    """File lengths by path lookup (SRC4, lookup form): path, length for exactly the given paths.

    Sees zero-length files and returns a null length for a missing file; see ``with_stat_lengths``.
    """
    return with_stat_lengths(paths.select(F.col(path_col).cast("string").alias("path")), default_fs=default_fs)


def read_file_status(spark: SparkSession, src: Source) -> DataFrame:
    """File status output of the aggregate job, five named columns (SRC5, PRJ7)."""
    return _typed(spark, src, schemas.FILE_STATUS)


def read_file_meta(spark: SparkSession, src: Source) -> DataFrame:
    """File meta output of the aggregate job (SRC6)."""
    return _typed(spark, src, schemas.FILE_META)


def sample_input_files(spark: SparkSession, path: str, schema: StructType, fraction: float,
                       seed: int = 0) -> tuple[list[str], float]:
    """A reproducible sample of a table's data files and the fraction of files it keeps.

    Row sampling reads every row before it drops any; sampling whole files reads only about
    ``fraction`` of the bytes, which is what makes a statistics pass (hot-key detection) cheap
    on a very large table. Files are chosen by a hash of their name; at least one is kept.
    """
    import zlib
    from urllib.parse import unquote

    # inputFiles() gives URIs (a space is "%20"); paths handed back to a reader are plain.
    files = sorted(unquote(f) for f in spark.read.schema(schema).parquet(path).inputFiles())
    if not files:
        return [], 1.0
    scale = 1_000_000
    keep = [f for f in files if zlib.crc32(f"{seed}:{f}".encode()) % scale < fraction * scale]
    if not keep:
        keep = [min(files, key=lambda f: zlib.crc32(f"{seed}:{f}".encode()))]
    return keep, len(keep) / len(files)


def write_bucketed(df: DataFrame, table: str, key: str, n_buckets: int, path: str | None = None) -> str:
    """Store an index as a catalog table bucketed and sorted by ``key`` (co-located joins).

    Joins on ``key`` with a side shuffled into ``n_buckets`` partitions (set
    ``spark.sql.shuffle.partitions`` to ``n_buckets`` for the job) then read the index without
    shuffling it: for the blob index that removes its shuffle from both the status and the meta
    step. ``path`` places the data files (an external table); otherwise the warehouse is used.
    """
    # Dealt by the key first: otherwise each write task would open a file for every bucket.
    writer = df.repartition(n_buckets, key).write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def run_sub_path(base_folder: str, sub_folder: str) -> str:
    """Full path of a run output from the base folder and a sub folder (base must end in '/')."""
    if not base_folder:
        raise ValueError("base folder must be given")
    if not base_folder.endswith("/"):
        raise ValueError("base folder must end with '/'")
    return base_folder + sub_folder.lstrip("/")


def read_run_file_status(spark: SparkSession, base_folder: str, sub_folder: str) -> DataFrame:
    """File status of a chosen, committed run: base folder + sub folder."""
    from blobtally.plans.layout import committed_output

    return read_file_status(spark, committed_output(spark, run_sub_path(base_folder, sub_folder)))


def read_run_file_meta(spark: SparkSession, base_folder: str, sub_folder: str) -> DataFrame:
    """File meta of a chosen, committed run: base folder + sub folder."""
    from blobtally.plans.layout import committed_output

    return read_file_meta(spark, committed_output(spark, run_sub_path(base_folder, sub_folder)))
