"""The change feed as a stream over index files that are only ever added."""

from .changes import read_index_stream, stream_changes, write_available
from .snapshots import read_snapshot_stream

__all__ = ["read_index_stream", "read_snapshot_stream", "stream_changes", "write_available"]
