"""Operators over DataFrames: scopes, the change feed, content, chunks, statistics."""

from ..balance import balanced_join, measure, range_sorted
from .chunks import chunk_words
from .content import (
    document_rows,
    extract_page_text,
    load_documents,
    load_elements,
    missing_files,
    outcome_rows,
    outcomes,
    present_files,
    process_files,
    split_elements,
)
from .feed import (
    all_files,
    changed_between,
    deleted_files,
    directory_changes,
    document_feed,
    latest_snapshot,
    latest_snapshot_row,
    matching_entries,
    new_files,
    regular_files,
    scan_scope,
    to_feed,
)
from .paging import number_pages, ordered, page_after
from .pieces import chunk_pieces, element_pieces, whole_documents
from .scope import (
    DatasetScope,
    FolderScope,
    in_dataset,
    make_scope,
    scope_condition,
    under_folder,
)
from .stats import element_stats, elements_by_source, elements_by_type, run_summary

__all__ = [
    "DatasetScope",
    "FolderScope",
    "all_files",
    "balanced_join",
    "changed_between",
    "chunk_pieces",
    "chunk_words",
    "deleted_files",
    "directory_changes",
    "document_feed",
    "document_rows",
    "element_pieces",
    "element_stats",
    "elements_by_source",
    "elements_by_type",
    "extract_page_text",
    "in_dataset",
    "latest_snapshot",
    "latest_snapshot_row",
    "load_documents",
    "load_elements",
    "make_scope",
    "matching_entries",
    "measure",
    "missing_files",
    "new_files",
    "number_pages",
    "ordered",
    "outcome_rows",
    "outcomes",
    "page_after",
    "present_files",
    "process_files",
    "range_sorted",
    "regular_files",
    "run_summary",
    "scan_scope",
    "scope_condition",
    "split_elements",
    "to_feed",
    "under_folder",
    "whole_documents",
]
