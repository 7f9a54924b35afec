"""Folder and file-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every folder in the index lies below this root.
DEFAULT_ROOT = "/ifs"

FOLDER_MODES = ("prefix", "subtree", "phrase")


def normalise_folder(folder: str, root: str = DEFAULT_ROOT) -> str:
    """Drop slashes and blanks at the end, in any mixture, and check the root."""
    if not folder.startswith(root):
        raise ValueError(f"folder must start with {root!r}: {folder!r}")
    end = len(folder)
    while end and (folder[end - 1] == "/" or folder[end - 1].isspace()):
        end -= 1
    return folder[:end]


def folder_condition(folder: str, mode: str = "prefix", column: str = "path") -> Column:
    """Rows whose path matches an already normalised folder.

    ``prefix``   anchored; the last component may be partial, so ``/ifs/data``
                 also takes ``/ifs/data2/x``.
    ``subtree``  the folder itself and what lies below it.
    ``phrase``   the components one after another anywhere in the path, the
                 last one possibly partial. Cannot prune row groups.

    The folder is compared as plain text, so ``%`` and ``_`` mean themselves.
    """
    path = F.col(column)
    if mode == "prefix":
        return path.startswith(folder)
    if mode == "subtree":
        return (path == folder) | path.startswith(folder + "/")
    if mode == "phrase":
        return path.contains(folder)
    raise ValueError(f"folder mode must be one of {FOLDER_MODES}: {mode!r}")


def file_name(column: str | Column) -> Column:
    """Last component of a path."""
    return F.substring_index(column, "/", -1)
