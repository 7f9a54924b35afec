"""Change types of an index entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The change types an index entry carries for a file that
# appeared and for a file that went away.
ENTRY_ADDED = "ENTRY_ADDED"
ENTRY_DELETED = "ENTRY_DELETED"


def change_list(column: str | Column) -> Column:
    """The list itself, or the empty list when the entry has none."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col, F.array().cast("array<string>"))


def has_change(change_type: str, column: str = "change_types") -> Column:
    return F.array_contains(F.col(column), change_type)
