"""Per-file space accounting: which blob files are how empty, and where their live blobs lie.

Plan of ``file_status`` (one Catalyst plan, three shuffles on small-to-large keys):

1. references -> partial+final aggregation per uri (n_refs, n_live): hot uris collapse map-side;
2. join with the blob index on uri (both sides now unique per uri); the aggregate job does 1 and 2 as one
   aggregation of references and index rows, unless the index lies bucketed by uri (``co_located``);
3. aggregation per file_id: remaining bytes = sum(n_live * length), all-archived = no live ref;
4. join the file index (path not null) on file_id, then the file lengths on path (left join:
   all-archived files need no length), both after aggregation, i.e. one row per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from blobtally import schemas
from blobtally.functions.columns import empty_percent, is_archived, meta_row_key
from blobtally.operators.joins import hot_key_sketch, lookup_join
from blobtally.operators.ordered import with_sort_position
from blobtally.operators.refs import blob_sample_filter, observe_lookups, refs_beside_index, refs_per_uri
from blobtally.sources.tables import with_stat_lengths


def archived_flag(objects: DataFrame, archive_bucket: str) -> DataFrame:
    """Object key with its archived flag (PRD1)."""
    return objects.select("object_key", is_archived("object_key", archive_bucket).alias("archived"))


def live_refs(resolved: DataFrame, archive_bucket: str) -> DataFrame:
    """Resolved references of objects outside the archive bucket (FLT5)."""
    return resolved.filter(~is_archived("object_key", archive_bucket))


def _uri_totals(refs: DataFrame, blob_index: DataFrame, archive_bucket: str,
                observe: bool = False, sampled: Column | None = None):
    if observe and sampled is not None:
        return observe_lookups(refs_beside_index(refs, blob_index, is_archived("object_key", archive_bucket), sampled), weight="n_refs")
    per_uri = refs_per_uri(refs, is_archived("object_key", archive_bucket))
    # blob_id is only read when sampling; otherwise column pruning drops it from the scan.
    index = blob_index.select("uri", "file_id", "length", "blob_id")
    if not observe:
        return per_uri.join(index, "uri"), None
    joined, obs = observe_lookups(per_uri.join(index, "uri", "left"), weight="n_refs")
    return joined.filter(F.col("file_id").isNotNull()), obs


def file_totals(refs: DataFrame, blob_index: DataFrame, archive_bucket: str,
                observe: bool = False, sample_fraction: float = 1.0, co_located: bool = True):
    """Per blob file: n_refs, n_live, remain_size (bytes of live references), all_archived.

    Bag semantics: every reference counts, so a blob listed twice counts twice.
    With ``observe=True`` returns ``(frame, Observation)`` carrying lookup hits and misses.
    ``sample_fraction`` < 1 keeps a reproducible per-blob sample of the resolved references; references
    with a mark ``kept`` (``refs.mark_sample``) are sampled singly. Hits and misses count all.
    Observed and not ``co_located``, references and index rows are aggregated together (``refs.refs_beside_index``,
    which also checks that the index holds a uri once) and not joined.
    """
    merged = observe and not co_located
    resolved, obs = _uri_totals(refs, blob_index, archive_bucket, observe, blob_sample_filter(sample_fraction) if merged else None)
    if merged:
        resolved = resolved.filter(F.col("file_id").isNotNull() & F.col("sampled"))
    if "n_kept" in resolved.columns:
        resolved = resolved.filter(F.col("n_kept") > 0).withColumn("n_refs", F.col("n_kept"))
    if sample_fraction < 1.0 and not merged:
        # Per blob, so all references to one blob are kept or dropped together and the per-uri
        # pre-aggregation stays valid.
        resolved = resolved.filter(blob_sample_filter(sample_fraction))
    # Long arithmetic that reports overflow as null (a blob referenced billions of times can
    # exceed 2^63 bytes in bag semantics); an overflowing file fails the run.
    # A null length counts as 0 bytes; only a null product of non-null inputs, or a null sum
    # over at least one non-null product, is an overflow.
    live_bytes = F.try_multiply(F.col("n_live"), F.col("length"))
    overflowed = (live_bytes.isNull() & F.col("length").isNotNull()).cast("int")
    totals = resolved.groupBy("file_id").agg(
        F.sum("n_refs").cast("bigint").alias("n_refs"),
        F.sum("n_live").cast("bigint").alias("n_live"),
        F.try_sum(live_bytes).alias("_live_bytes"),
        F.count(live_bytes).alias("_summed"),
        F.max(overflowed).alias("_overflow"))
    overflow = (F.col("_overflow") == 1) | (F.col("_live_bytes").isNull() & (F.col("_summed") > 0)) \
        | (F.col("_live_bytes") == schemas.ARCHIVED_REMAIN_SIZE)
    remain = F.when(overflow, F.raise_error(F.concat(
        F.lit("remaining bytes exceed 2^63 in file "), F.col("file_id").cast("string"))).cast("bigint")) \
        .otherwise(F.coalesce(F.col("_live_bytes"), F.lit(0)))
    totals = totals.select("file_id", "n_refs", "n_live", remain.cast("bigint").alias("remain_size"),
                           (F.col("n_live") == 0).alias("all_archived"))
    return (totals, obs) if observe else totals


def file_paths(totals: DataFrame, file_index: DataFrame) -> DataFrame:
    """Totals of files that have an index entry with a path (J2); joined after aggregation."""
    return totals.join(file_index.filter(F.col("path").isNotNull()), "file_id")


def file_lengths_join(with_paths: DataFrame, file_lengths: DataFrame) -> DataFrame:
    """Attach each file's stored length (J3).

    All-archived files skip the length lookup (they survive a missing file); other files
    without a length are dropped, as a failed length lookup drops the file.
    """
    return (with_paths.join(file_lengths.select("path", "length"), "path", "left")
            .filter(F.col("all_archived") | F.col("length").isNotNull()))


#: What becomes of a file with references, in the order in which the checks apply.
KEPT, NO_ENTRY, NO_PATH, NO_LENGTH = "kept", "no_entry", "no_path", "no_length"


def file_outcomes(totals: DataFrame, file_index: DataFrame, file_lengths: DataFrame | None = None,
                  stat_tasks: int | None = None) -> DataFrame:
    """Totals with path, length and ``outcome``: kept, or why a file gets no status row.

    ``no_entry``: not in the file index; ``no_path``: its entry has no path; ``no_length``: not all
    archived and no stored length (a null length counts as none). With ``file_lengths=None`` the
    paths of files that need a length are looked up in the store itself, by ``stat_tasks`` tasks
    (default: the number of shuffle partitions).
    """
    entry = file_index.select("file_id", "path", F.lit(True).alias("_entry"))
    found = totals.join(entry, "file_id", "left")
    if file_lengths is None:
        # Dealt again with a fixed count: a stat waits for the store, so few large tasks are slow.
        tasks = stat_tasks or int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        asked = found.withColumn("_asked", F.col("path").isNotNull() & ~F.col("all_archived"))
        sized = with_stat_lengths(asked.repartition(tasks, "file_id"), wanted="_asked").drop("_asked")
    else:
        # Files without a path get a key of their own that no path equals, so they do not meet in one task.
        at = F.coalesce("path", F.concat(F.lit("\0"), F.col("file_id").cast("string")))
        sized = (found.withColumn("_at", at)
                 .join(file_lengths.select(F.col("path").alias("_at"), "length"), "_at", "left").drop("_at"))
    outcome = (F.when(F.col("_entry").isNull(), F.lit(NO_ENTRY)).when(F.col("path").isNull(), F.lit(NO_PATH))
               .when(~F.col("all_archived") & F.col("length").isNull(), F.lit(NO_LENGTH)).otherwise(F.lit(KEPT)))
    return sized.withColumn("outcome", outcome).drop("_entry")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """One row per outcome that occurs: its number of files and of references."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_files"),
                                           F.sum("n_refs").cast("bigint").alias("n_refs"))


def status_columns(df: DataFrame) -> DataFrame:
    """AGG4: the five stored columns of file status."""
    archived = F.col("all_archived")
    return df.select(
        F.col("file_id").cast("bigint").alias("file_id"),
        F.when(archived, F.lit(schemas.ARCHIVED_EMPTY_PERCENT))
        .otherwise(empty_percent("length", "remain_size")).cast("int").alias("emptyPercent"),
        F.when(archived, F.lit(schemas.ARCHIVED_REMAIN_SIZE))
        .otherwise(F.col("remain_size")).cast("bigint").alias("remainSize"),
        F.col("path").cast("string").alias("path"),
        F.lit(False).alias("deleted"))


def file_status(refs: DataFrame, blob_index: DataFrame, file_index: DataFrame,
                file_lengths: DataFrame | None, archive_bucket: str, sample_fraction: float = 1.0,
                observe: bool = False, sketch_hot_keys: bool = False, co_located: bool = True):
    """File status of every blob file that has references, an index path and (unless all
    archived) a stored length. Columns: file_id, emptyPercent, remainSize, path, deleted.

    With ``file_lengths=None`` lengths are looked up in the store (``file_outcomes``). With
    ``observe=True`` returns ``(frame, [Observation, ...])``: lookup hits and misses, and the
    number of files by outcome (``files``, ``files_no_entry``, ``files_no_path``, ``files_no_length``).
    ``sketch_hot_keys`` adds an Observation whose ``hot_keys`` is the heavy-hitter sketch of the uris,
    filled in the same pass. ``co_located`` as in ``file_totals``.
    """
    if not observe and file_lengths is not None:
        totals = file_totals(refs, blob_index, archive_bucket, sample_fraction=sample_fraction)
        return status_columns(file_lengths_join(file_paths(totals, file_index), file_lengths))
    sketch = []
    if sketch_hot_keys:
        sketch = [Observation("hot_keys")]
        refs = refs.observe(sketch[0], hot_key_sketch("uri").alias("hot_keys"))
    totals, lookups = file_totals(refs, blob_index, archive_bucket, observe=True, sample_fraction=sample_fraction,
                                  co_located=co_located)
    files = Observation("files")
    counted = {KEPT: "files", NO_ENTRY: "files_no_entry", NO_PATH: "files_no_path", NO_LENGTH: "files_no_length"}
    outcomes = file_outcomes(totals, file_index, file_lengths) \
        .observe(files, *[F.count_if(F.col("outcome") == o).alias(name) for o, name in counted.items()])
    status = status_columns(outcomes.filter(F.col("outcome") == KEPT))
    return (status, [lookups, files, *sketch]) if observe else status


def file_meta(refs: DataFrame, blob_index: DataFrame, status: DataFrame, archive_bucket: str,
              key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER,
              skew_rows: int | None = None, broadcast_files: int | None = None,
              hot_keys: list | None = None, n_files: int | None = None,
              sample_fraction: float = 1.0) -> DataFrame:
    """One meta row per live reference of a file whose status survived (PRJ3).

    The live references are looked up in the blob index by uri and rows of other files go. With
    ``broadcast_files``, the surviving file ids are counted and, if there are at most that many (a
    checked bound), broadcast, so the index is filtered map-side before the lookup. Beyond it the
    meta rows are joined with the file ids after the lookup: a bucketed index is then read in place
    at every size, and the one shuffle by file_id moves meta rows. The result is the same.
    Hot uris leave the shuffle join (``hot_keys`` given, or found with ``skew_rows``). Of references with a
    mark ``kept`` only the kept ones count.
    ``n_files`` passes a known row count of ``status`` so it is not counted again.
    ``sample_fraction`` < 1 keeps the same per-blob sample as ``file_totals``.
    """
    if "kept" in refs.columns:
        refs = refs.filter("kept")
    live = refs.filter(~is_archived("object_key", archive_bucket)).select("object_key", "uri")
    files = status.select("file_id")
    index = blob_index.select("uri", "file_id", "blob_id", "start", "length")
    few = broadcast_files is not None and (n_files if n_files is not None else files.count()) <= broadcast_files
    if few:
        index = index.join(F.broadcast(files), "file_id", "left_semi")
    joined = lookup_join(live, index, "uri", "inner", skew_rows=skew_rows, hot_keys=hot_keys)
    if not few:
        # An inner join with distinct ids: the optimizer would push a semi join below the lookup.
        joined = joined.join(files.distinct(), "file_id")
    if sample_fraction < 1.0:
        joined = joined.filter(blob_sample_filter(sample_fraction))
    return joined.select(meta_row_key("file_id", "blob_id", key_delimiter).alias("meatRowKey"),
                         F.col("object_key").alias("objectKey"),
                         F.col("start").cast("bigint").alias("start"),
                         F.col("length").cast("bigint").alias("length"))


def meta_file_id(meta: DataFrame, key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER):
    """File id column recovered from a meta row key (the id is the part before the delimiter)."""
    return F.substring_index(F.col("meatRowKey"), key_delimiter, 1).cast("bigint")


def file_meta_lists(meta: DataFrame, key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER) -> DataFrame:
    """AGG5 summarised: per file, the count, total length and key range of its meta rows, by
    streaming aggregates; no group is collected. ``meta_lists`` gives the lists themselves."""
    return (meta.withColumn("file_id", meta_file_id(meta, key_delimiter))
            .groupBy("file_id")
            .agg(F.count(F.lit(1)).alias("n_meta"),
                 F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("meta_length"),
                 F.min("meatRowKey").alias("first_key"),
                 F.max("meatRowKey").alias("last_key")))


DEFAULT_LIST_ROWS = 10_000


def meta_lists(meta: DataFrame, max_rows: int = DEFAULT_LIST_ROWS,
               key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER) -> DataFrame:
    """AGG5: every file's meta rows as numbered lists of at most ``max_rows`` rows each.

    Rows are numbered in file order (start, key, object, length) by a distributed sort, so a file of any
    size is spread over tasks, and no list is longer than ``max_rows``. Returns file_id,
    list_no (from 0), rows: an array of the meta columns in order.
    """
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    keyed = meta.select(meta_file_id(meta, key_delimiter).alias("file_id"), *schemas.META_COLUMNS)
    placed = with_sort_position(keyed, ["file_id", "start", "meatRowKey", "objectKey", "length"], "_pos")
    first = placed.groupBy("file_id").agg(F.min("_pos").alias("_first"))
    place = F.col("_pos") - F.col("_first")
    numbered = placed.join(first, "file_id").withColumn("list_no", F.call_function("div", place, F.lit(max_rows)))
    rows = F.sort_array(F.collect_list(F.struct("_pos", F.struct(*schemas.META_COLUMNS).alias("row"))))
    return numbered.groupBy("file_id", "list_no").agg(F.transform(rows, lambda x: x["row"]).alias("rows"))


def flatten_lists(lists: DataFrame) -> DataFrame:
    """PRJ5: numbered lists -> one meta row for each entry, with file_id, list_no and its place in the list."""
    return lists.select("file_id", "list_no", F.posexplode("rows").alias("place", "row")) \
        .select("file_id", "list_no", "place", "row.*")


def flatten_meta(meta: DataFrame, key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER,
                 num_partitions: int | None = None) -> DataFrame:
    """Meta rows laid out file by file, each file's rows contiguous and ordered by start.

    Range partitioning on (file, start) keeps a global order, so one very large file spreads
    over several consecutive partitions instead of one task.
    """
    fid = meta_file_id(meta, key_delimiter)
    keyed = meta.withColumn("_file_id", fid)
    if num_partitions:
        keyed = keyed.repartitionByRange(num_partitions, "_file_id", "start", "meatRowKey")
    else:
        keyed = keyed.repartitionByRange("_file_id", "start", "meatRowKey")
    return keyed.sortWithinPartitions("_file_id", "start", "meatRowKey").select(*schemas.META_COLUMNS)
