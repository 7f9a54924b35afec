"""Incremental file-change feeds on Spark."""

from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .plans import ContentLoader, DocumentLoader, IncrementalRun, PathLoader
from .sources import *  # noqa: F403
from .sources import __all__ as _sources
from .streaming import read_index_stream, read_snapshot_stream, stream_changes, write_available

__all__ = [
    *_operators,
    *_sources,
    "ContentLoader",
    "DocumentLoader",
    "IncrementalRun",
    "PathLoader",
    "read_index_stream",
    "read_snapshot_stream",
    "stream_changes",
    "write_available",
]
