"""Sinks of the aggregate job: file status and file meta as Parquet, each at its own path.

``mode('overwrite')`` replaces an earlier output as part of the write itself (SNK3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from blobtally import schemas


def _write(df: DataFrame, schema: StructType, path: str) -> str:
    if not path:
        raise ValueError("output path must be given")
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]) \
        .write.mode("overwrite").parquet(path)
    return path


def write_file_status(df: DataFrame, path: str) -> str:
    """SNK1: file status, the five stored columns."""
    return _write(df, schemas.FILE_STATUS, path)


def write_file_meta(df: DataFrame, path: str) -> str:
    """SNK2: file meta rows, at the meta path (never the status path)."""
    return _write(df, schemas.FILE_META, path)


def write_split_assignment(df: DataFrame, path: str) -> str:
    """Split plan of the compact job."""
    return _write(df, schemas.SPLIT_ASSIGNMENT, path)
