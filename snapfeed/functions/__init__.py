"""Column expressions; every one stays inside the JVM."""

from .changes import (
    ENTRY_ADDED,
    ENTRY_DELETED,
    change_list,
    has_change,
)
from .paths import file_name, folder_condition, normalise_folder
from .text import element_category, page_text, split_words, trim_line

__all__ = [
    "ENTRY_ADDED",
    "ENTRY_DELETED",
    "change_list",
    "element_category",
    "file_name",
    "folder_condition",
    "has_change",
    "normalise_folder",
    "page_text",
    "split_words",
    "trim_line",
]
