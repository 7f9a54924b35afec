"""Readers and writers: file index, dataset definitions, checkpoints, file content."""

from .checkpoints import CheckpointLog, current_checkpoints, last_snapshot, last_snapshot_row
from .content_table import ContentTable
from .datasets import dataset_predicate
from .failures import FailureLedger
from .files import open_changed_files, packed_files
from .index import flatten_index, nest_index, read_index, recorded_high, write_index
from .manifest import IndexTable

__all__ = [
    "CheckpointLog",
    "ContentTable",
    "FailureLedger",
    "IndexTable",
    "current_checkpoints",
    "dataset_predicate",
    "flatten_index",
    "last_snapshot",
    "last_snapshot_row",
    "nest_index",
    "open_changed_files",
    "packed_files",
    "read_index",
    "recorded_high",
    "write_index",
]
