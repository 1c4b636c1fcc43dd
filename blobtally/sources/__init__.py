"""Sources: typed readers of the store's tables and the job outputs, plus derived fixtures."""

from blobtally.sources.cell_store import DirectoryCellStore, put_cells, read_cell_store, read_manifest
from blobtally.sources.listing import list_tree
from blobtally.sources.tables import (
    list_file_lengths,
    read_blob_index,
    read_file_index,
    read_file_lengths,
    read_file_meta,
    read_file_status,
    read_objects,
    read_run_file_meta,
    read_run_file_status,
    run_sub_path,
    sample_input_files,
    stat_file_lengths,
    with_stat_lengths,
    write_bucketed,
)

__all__ = [
    "DirectoryCellStore",
    "put_cells",
    "read_cell_store",
    "read_manifest",
    "list_file_lengths",
    "list_tree",
    "read_blob_index",
    "read_file_index",
    "read_file_lengths",
    "read_file_meta",
    "read_file_status",
    "read_objects",
    "read_run_file_meta",
    "read_run_file_status",
    "run_sub_path",
    "sample_input_files",
    "stat_file_lengths",
    "write_bucketed",
]
