"""Run layout: <base>aggregator/<yyyy-MM-dd>/<epoch millis>/{file_status,file_meta}.

The driver builds the two paths of one run as strings; ``catalog_runs`` lists every run under
a base folder as a DataFrame (distributed listing), using the column forms in
``blobtally.functions``.

Both outputs of a run appear together. They are written below ``_attempt-<id>`` in the run's folder; the
rename that creates ``_commit-<number>-<id>`` publishes them, and only then do they replace an earlier
run's outputs. A reader takes the greatest number's attempt: from its own folder as long as it is
there, else from the run's folder. So a run that is killed anywhere leaves either the old outputs or
the new ones, never a mixture, and a run without a commit record is no run.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobtally.functions.columns import run_timestamp
from blobtally.sources.listing import list_tree


@dataclass(frozen=True)
class RunPaths:
    day: str
    millis: int
    status: str
    meta: str


def _check_base(base: str) -> None:
    if not base:
        raise ValueError("base path must be given (it is the folder that holds 'aggregator/')")
    if not base.endswith("/"):
        raise ValueError("base path must end with '/'")


def run_paths(base: str, when: datetime | None = None) -> RunPaths:
    """Paths of the run started at ``when`` (default: now); the day is taken in UTC.

    A naive ``when`` is local time, as everywhere in Python; millis are truncated, not rounded,
    so the day and the millis always name the same instant.
    """
    _check_base(base)
    when = (when or datetime.now(timezone.utc)).astimezone(timezone.utc)
    millis = (when - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)
    day = when.strftime("%Y-%m-%d")
    run_dir = f"{base}aggregator/{day}/{millis}"
    return RunPaths(day, millis, f"{run_dir}/file_status", f"{run_dir}/file_meta")


def run_timestamp_of(path: str) -> int:
    """Run timestamp (epoch millis) of a run output path; ValueError if it has none."""
    parts = [p for p in path.rstrip("/").split("/")]
    try:
        return int(parts[-2])
    except (IndexError, ValueError):
        raise ValueError(f"not a run output path: {path!r}") from None


OUTPUTS = ("file_status", "file_meta")
_COMMIT = r"_commit-(\d{6})-([0-9a-f]+)"


def _fs(spark: SparkSession, path: str):
    """Hadoop filesystem of a path, and the class of its paths."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def _commits(spark: SparkSession, run_dir: str) -> list[tuple[int, str]]:
    """(number, attempt) of a run's commit records, in order."""
    fs, at = _fs(spark, run_dir)
    if not fs.exists(at(run_dir)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at(run_dir))]
    return sorted((int(m[1]), m[2]) for m in map(re.compile(_COMMIT + "$").match, names) if m)


def committed_output(spark: SparkSession, path: str) -> str:
    """Where the committed rows of a run's output (``.../<millis>/<output>``) are now.

    FileNotFoundError if the run has no commit record.
    """
    run_dir, kind = path.rstrip("/").rsplit("/", 1)
    commits = _commits(spark, run_dir)
    if not commits:
        raise FileNotFoundError(f"no committed run at {run_dir}")
    fs, at = _fs(spark, run_dir)
    staged = f"{run_dir}/_attempt-{commits[-1][1]}/{kind}"
    return staged if fs.exists(at(staged)) else f"{run_dir}/{kind}"


class Publication:
    """Outputs of one run on their way: staged, then committed, then moved to their places."""

    def __init__(self, spark: SparkSession, paths: RunPaths):
        self.spark, self.paths, self.attempt = spark, paths, uuid.uuid4().hex[:12]
        self.run_dir = paths.status.rsplit("/", 1)[0]

    def staged(self, kind: str) -> str:
        return f"{self.run_dir}/_attempt-{self.attempt}/{kind}"

    def commit(self, record: dict) -> None:
        """Publish what was staged, in one rename; OSError if another run committed at the same time."""
        fs, at = _fs(self.spark, self.run_dir)
        number = (_commits(self.spark, self.run_dir) or [(0, "")])[-1][0] + 1
        draft = at(f"{self.run_dir}/_draft-{self.attempt}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        if not fs.rename(draft, at(f"{self.run_dir}/_commit-{number:06d}-{self.attempt}")):
            raise OSError(f"could not commit the run at {self.run_dir}")
        if [n for n, _ in _commits(self.spark, self.run_dir)].count(number) > 1:
            raise OSError(f"another run was committed at {self.run_dir}")

    def settle(self) -> None:
        """Move committed outputs to the run's folder, in place of earlier ones. May be cut off anywhere."""
        fs, at = _fs(self.spark, self.run_dir)
        for kind in OUTPUTS:
            if fs.exists(at(self.staged(kind))):
                fs.delete(at(f"{self.run_dir}/{kind}"), True)
                if not fs.rename(at(self.staged(kind)), at(f"{self.run_dir}/{kind}")):
                    raise OSError(f"could not move {self.staged(kind)}")
        fs.delete(at(f"{self.run_dir}/_attempt-{self.attempt}"), True)


def read_commit(spark: SparkSession, run_dir: str) -> dict:
    """The record of a run's latest commit (its counters)."""
    number, attempt = _commits(spark, run_dir)[-1]
    fs, at = _fs(spark, run_dir)
    file = at(f"{run_dir}/_commit-{number:06d}-{attempt}")
    source = fs.open(file)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode())
    finally:
        source.close()


def catalog_runs(spark: SparkSession, base: str) -> DataFrame:
    """Every output of a committed run under ``base``: run_dir, output kind, day, run_ts, n_files.

    Tasks list the folders (``sources.listing.list_tree``); the records' names say which attempt
    counts, and run timestamps come from the column form of ``run_timestamp``. Runs without a
    commit record are left out.
    """
    _check_base(base)
    files = list_tree(spark, base + "aggregator").select("path")
    commits = files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("run_dir"),
                           F.regexp_extract("path", f"/({_COMMIT})$", 1).alias("_record")).where("_record <> ''") \
        .groupBy("run_dir").agg(F.max("_record").alias("_record")) \
        .select("run_dir", F.regexp_extract("_record", _COMMIT, 2).alias("_attempt"))
    part = r"^(.*/\d{4}-\d{2}-\d{2}/[^/]+)/(?:_attempt-([0-9a-f]+)/)?([A-Za-z][^/]*)/[^/]+\.parquet$"
    parts = files.select(*[F.regexp_extract("path", part, i).alias(c) for i, c in ((1, "run_dir"), (2, "_of"), (3, "kind"))]).where("run_dir <> ''")
    counted = parts.join(commits, "run_dir").where("_of = '' OR _of = _attempt").groupBy("run_dir", "kind").agg(
        F.count_if(F.col("_of") != "").alias("_staged"), F.count_if(F.col("_of") == "").alias("_settled"))
    return counted.select("run_dir", "kind", F.regexp_extract("run_dir", r"/(\d{4}-\d{2}-\d{2})/[^/]+$", 1).alias("day"),
                          run_timestamp(F.concat("run_dir", F.lit("/"), "kind")).alias("run_ts"),
                          F.when(F.col("_staged") > 0, F.col("_staged")).otherwise(F.col("_settled")).alias("n_files"))
