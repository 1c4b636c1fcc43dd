"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast when a side turns out
# small, split skewed partitions of N:1 lookups); UTC fixes date formatting of run paths.
# Broadcast policy: no broadcast from planning-time size *estimates* (an estimate taken before an
# explode can be off by the fan-out); AQE broadcasts only sides whose shuffle output it has
# measured to be under the adaptive threshold, and explicit hints are used only for sides with
# a proven row bound (the hot-key index in operators.joins).
SESSION_DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of DataFrames that are no longer referenced are removed by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "blobtally",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffle_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
               min_partitions: int = 200) -> dict:
    """Settings for a run that shuffles about ``shuffle_bytes``: partitions of ~``partition_bytes``.

    Shuffle partitions are sized so each reducer holds one partition's worth (AQE coalesces
    smaller ones at runtime and splits skewed ones); input splits and AQE's advisory size use
    the same target. When the blob index is stored bucketed, use its bucket count instead.
    """
    n = max(min_partitions, -(-int(shuffle_bytes) // int(partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session (tests, benches) without one gets a fresh temporary
    folder; on a cluster a machine-local folder would not survive an executor loss, so an
    unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                               "object store) for checkpoints and intermediate tables")
        configured = tempfile.mkdtemp(prefix="blobtally-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub folder of the shared checkpoint folder for written intermediate tables.

    The folder is removed when the Python process ends while the application still runs.
    """
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_drop_scratch)
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: every executor can read the copy,
    so a lost one costs the tasks that were running and nothing before them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop_scratch() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
