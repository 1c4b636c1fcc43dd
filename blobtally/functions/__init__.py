"""Column expressions: all JVM-side built-ins, so they stay inside whole-stage codegen."""

from blobtally.functions.columns import (
    bytes_to_long,
    cell_label,
    decode_utf8,
    empty_percent,
    is_archived,
    meta_row_key,
    millis_instant,
    ntz_epoch_millis,
    region_bucket,
    run_day,
    run_file_meta_path,
    run_file_status_path,
    run_timestamp,
)

__all__ = [
    "bytes_to_long",
    "cell_label",
    "decode_utf8",
    "empty_percent",
    "is_archived",
    "meta_row_key",
    "millis_instant",
    "ntz_epoch_millis",
    "region_bucket",
    "run_day",
    "run_file_meta_path",
    "run_file_status_path",
    "run_timestamp",
]
