"""Operators of the space-accounting engine, each a function DataFrame(s) -> DataFrame."""

from blobtally.operators.cells import (
    add_region,
    bulk_load_cells,
    flat_map_cells,
    partition_by_region,
    sort_cells,
    to_cells,
    write_cells,
    write_cells_with,
)
from blobtally.operators.compact import apply_to_splits, mark_deleted, plan_relocation, plan_splits, split_summary
from blobtally.operators.table_splits import plan_table_splits
from blobtally.operators.ordered import as_of_join, with_sort_position
from blobtally.operators.joins import assert_unique, find_hot_keys, hot_key_sketch, lookup_join, unique_rows
from blobtally.operators.refs import (
    decode_objects,
    explode_refs,
    flatten_refs,
    lookup_counters,
    mark_sample,
    nest_refs,
    object_refs,
    observe_lookups,
    ref_count,
    refs_beside_index,
    refs_per_uri,
    resolve_refs,
    sample_refs,
    unresolved_refs,
    valid_objects,
)
from blobtally.operators.status import (
    archived_flag,
    file_lengths_join,
    file_meta,
    file_meta_lists,
    file_outcomes,
    file_paths,
    file_status,
    file_totals,
    flatten_lists,
    flatten_meta,
    live_refs,
    meta_lists,
    outcome_counts,
    status_columns,
)

__all__ = [
    "add_region", "as_of_join", "bulk_load_cells", "flat_map_cells", "partition_by_region", "sort_cells",
    "to_cells", "with_sort_position", "write_cells", "write_cells_with",
    "apply_to_splits", "mark_deleted", "plan_relocation", "plan_splits", "plan_table_splits", "split_summary",
    "assert_unique", "find_hot_keys", "hot_key_sketch", "lookup_join", "unique_rows",
    "decode_objects", "explode_refs", "flatten_refs", "lookup_counters", "mark_sample", "nest_refs", "object_refs",
    "observe_lookups", "ref_count", "refs_beside_index", "refs_per_uri", "resolve_refs", "sample_refs", "unresolved_refs",
    "valid_objects",
    "archived_flag", "file_lengths_join", "file_meta", "file_meta_lists", "file_outcomes", "file_paths",
    "file_status", "file_totals", "flatten_lists", "flatten_meta", "live_refs", "meta_lists", "outcome_counts", "status_columns",
]
