"""The two jobs: aggregate (per-file status and meta) and compact (split and relocation plans).

Both are plain sequences of DataFrame plans and writes. The aggregate job stages the status
first and reads it back for the meta step, so the meta plan starts from a written table rather
than a long lineage (and a lost executor never recomputes the status aggregation); both outputs are
then published together.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from blobtally import schemas
from blobtally.operators import compact
from blobtally.operators.joins import hot_keys_of, unique_rows
from blobtally.operators.refs import mark_sample, object_refs
from blobtally.operators.status import file_meta, file_status
from blobtally.plans import sinks
from blobtally.plans.layout import Publication, committed_output, run_paths, run_timestamp_of
from blobtally.sources import tables

DEFAULT_SKEW_ROWS = 1_000_000
# Surviving files whose ids may be broadcast (8-byte keys: ~16 MB of hash table at 1M files).
DEFAULT_BROADCAST_FILES = 1_000_000


@dataclass
class AggregateResult:
    exit_code: int
    status_path: str
    meta_path: str
    counters: dict = field(default_factory=dict)
    error: str | None = None


@dataclass
class CompactResult:
    exit_code: int
    run_ts: int
    splits_path: str
    relocation_path: str | None
    counters: dict = field(default_factory=dict)


def run_aggregate(spark: SparkSession, objects, blob_index, file_index, file_lengths,
                  base: str, when: datetime | None = None, *, archive_bucket: str,
                  key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER,
                  sample_fraction: float = 1.0, ref_fraction: float = 1.0, ref_digest: Column | None = None,
                  skew_rows: int | None = DEFAULT_SKEW_ROWS,
                  broadcast_files: int | None = DEFAULT_BROADCAST_FILES, co_located: bool = False) -> AggregateResult:
    """JOB1: object table + indexes -> file status and file meta under the run's folder.

    Inputs are paths or DataFrames with the schemas in ``blobtally.schemas`` (the object table
    raw, as bytes). Uris with at least ``skew_rows`` references, which the status pass sketches on its way,
    leave the shuffle of the meta lookup. ``sample_fraction`` < 1 keeps a reproducible sample of blobs,
    ``ref_fraction`` < 1 one of single references (``refs.mark_sample``; ``ref_digest`` replaces its hash);
    status and meta keep the same ones (the original always sampled 1 % of the references).
    ``file_lengths=None`` looks the lengths up in the store, for files that are not all archived;
    paths without scheme belong to the configured default filesystem. ``co_located`` says that the blob index is a
    table bucketed by uri (``sources.write_bucketed``), which the status pass then joins where it lies; else it
    aggregates references and index rows together, which takes less memory a task.

    Both outputs are staged and published together by one commit record (``plans.layout``), so readers see
    the old run's or the new run's. Returns exit code 0 with the two paths, the lookup counters (hits, misses),
    the number of files written and of files left out (files_no_entry, files_no_path, files_no_length), or
    exit code -1 and the error if the outputs could not be published. A failing computation raises.
    """
    paths = run_paths(base, when)
    run = Publication(spark, paths)
    refs = object_refs(tables.read_objects(spark, objects), numbered=ref_fraction < 1.0)
    if ref_fraction < 1.0:
        refs = mark_sample(refs, ref_fraction, ref_digest)
    blobs = tables.read_blob_index(spark, blob_index)
    # A repeated key in a lookup source would multiply references, so it fails the run.
    lengths = None if file_lengths is None else unique_rows(tables.read_file_lengths(spark, file_lengths), "path")
    status, observed = file_status(refs, unique_rows(blobs, "uri") if co_located else blobs,
                                   unique_rows(tables.read_file_index(spark, file_index), "file_id"), lengths,
                                   archive_bucket, sample_fraction=sample_fraction, observe=True,
                                   sketch_hot_keys=skew_rows is not None, co_located=co_located)
    sinks.write_file_status(status, run.staged("file_status"))
    counters = {name: n for obs in observed for name, n in obs.get.items()}
    # The status pass has counted the references and sketched their hot uris on the way.
    hot = hot_keys_of(counters.pop("hot_keys", None), skew_rows or 0)

    written = tables.read_file_status(spark, run.staged("file_status"))
    meta = file_meta(refs, blobs, written, archive_bucket, key_delimiter,
                     broadcast_files=broadcast_files, hot_keys=hot, n_files=counters["files"],
                     sample_fraction=sample_fraction)
    sinks.write_file_meta(meta, run.staged("file_meta"))
    try:
        run.commit({"counters": counters, "status_rows": counters["files"]})
    except (OSError, Py4JJavaError) as error:
        return AggregateResult(-1, paths.status, paths.meta, counters, str(error))
    run.settle()
    return AggregateResult(0, paths.status, paths.meta, counters)


def run_compact(spark: SparkSession, base_folder: str, status_sub_path: str, out_path: str, *,
                max_bytes: int, files_per_group: int = compact.DEFAULT_FILES_PER_GROUP, meta_sub_path: str | None = None,
                include_archived: bool = True, merge_tails: bool = False, groups_per_tail: int = compact.DEFAULT_GROUPS_PER_TAIL,
                key_delimiter: str = schemas.DEFAULT_KEY_DELIMITER) -> CompactResult:
    """JOB2: a run's file status -> split plan (and, given the meta, a relocation plan).

    The status path is base folder + sub path of a committed run; its run timestamp must parse from the path.
    Writes ``<out_path>/splits`` and optionally ``<out_path>/relocation``. ``key_delimiter``
    must be the one the aggregate run wrote into the meta row keys.
    """
    status_path = tables.run_sub_path(base_folder, status_sub_path)
    run_ts = run_timestamp_of(status_path)
    obs = Observation("compact_input")
    status: DataFrame = tables.read_file_status(spark, committed_output(spark, status_path)) \
        .observe(obs, F.count(F.lit(1)).alias("input_rows"))
    assigned = compact.plan_splits(status, max_bytes, files_per_group, include_archived=include_archived,
                                   merge_tails=merge_tails, groups_per_tail=groups_per_tail)
    out = out_path.rstrip("/")
    splits_path = sinks.write_split_assignment(assigned, f"{out}/splits")
    counters = dict(obs.get)
    relocation_path = None
    if meta_sub_path:
        meta = tables.read_run_file_meta(spark, base_folder, meta_sub_path)
        plan = compact.plan_relocation(spark.read.schema(schemas.SPLIT_ASSIGNMENT).parquet(splits_path), meta,
                                       key_delimiter)
        relocation_path = f"{out}/relocation"
        plan.write.mode("overwrite").parquet(relocation_path)
    return CompactResult(0, run_ts, splits_path, relocation_path, counters)
