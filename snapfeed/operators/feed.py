"""The change feed: entries of a scope in a snapshot range, and its projections.

All of it is scan, filter and projection; nothing here shuffles except the
maximum snapshot, which is a partial maximum per task and one final row.
No entry is ever de-duplicated: a file that appears twice is delivered twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.changes import ENTRY_ADDED, ENTRY_DELETED, has_change
from .scope import Scope, above, is_regular, scope_condition, up_to


def regular_files(index: DataFrame) -> DataFrame:
    return index.where(is_regular())


def changed_between(index: DataFrame, low: int, high: int) -> DataFrame:
    """Entries with ``low < s2 <= high``."""
    return index.where(above(low) & up_to(high))


def latest_snapshot_row(index: DataFrame) -> DataFrame:
    """One row with the highest snapshot of the whole index, -1 if there is none."""
    return index.agg(F.coalesce(F.max("s2"), F.lit(-1).cast("bigint")).alias("snapshot"))


def latest_snapshot(index: DataFrame) -> int:
    return latest_snapshot_row(index).first().snapshot


def scan_scope(index: DataFrame, scope: Scope) -> DataFrame:
    """Regular files of a scope whatever their snapshot, also those without one."""
    return index.where(scope_condition(scope))


def matching_entries(index: DataFrame, scope: Scope, low: int, high: int) -> DataFrame:
    """Index entries of regular files of a scope in ``(low, high]``."""
    return index.where(scope_condition(scope, low, high))


def to_feed(entries: DataFrame) -> DataFrame:
    return entries.select("path", F.col("s2").alias("snapshot"), "change_types")


def directory_changes(index: DataFrame, scope: Scope, low: int, high: int) -> DataFrame:
    """Change feed: ``path, snapshot, change_types``."""
    return to_feed(matching_entries(index, scope, low, high))


def new_files(feed: DataFrame) -> DataFrame:
    return feed.where(has_change(ENTRY_ADDED)).select("path", "snapshot")


def deleted_files(feed: DataFrame) -> DataFrame:
    return feed.where(has_change(ENTRY_DELETED)).select("path", "snapshot")


def all_files(index: DataFrame, scope: Scope, high: int | None = None) -> DataFrame:
    """Additions after snapshot 0.

    Files that entered the index at snapshot 0 are not among them; use
    :func:`scan_scope` for every file of a scope.
    """
    upper = latest_snapshot(index) if high is None else high
    return new_files(directory_changes(index, scope, 0, upper))


def document_feed(feed: DataFrame) -> DataFrame:
    """One empty document per file, as a work list with metadata."""
    return feed.select(
        F.lit("").alias("page_content"),
        F.struct(F.col("path").alias("source"), "snapshot", "change_types").alias("metadata"),
    )
