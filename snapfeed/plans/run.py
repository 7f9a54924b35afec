"""One incremental run over an index."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.feed import (
    all_files,
    deleted_files,
    document_feed,
    latest_snapshot,
    matching_entries,
    new_files,
    to_feed,
)
from ..operators.scope import FolderScope, Scope
from ..sources.checkpoints import CheckpointLog
from ..sources.failures import FailureLedger
from ..sources.manifest import IndexTable

DEFAULT_APP = "snapfeed"
DEFAULT_VERSION = 1


def consumed(function: Callable[[DataFrame], Any], feed: DataFrame, commit: Callable[[], bool]) -> Any:
    """What ``function`` makes of the feed, committed afterwards; a lazy result is refused."""
    result = function(feed)
    if isinstance(result, DataFrame):
        raise ValueError("nothing was committed: store the rows within the function")
    commit()
    return result


class IncrementalRun:
    """What changed in a scope since the last commit, up to a fixed snapshot.

    Both bounds of ``(low, high]`` are read once, when first needed, and stay as
    they are for the life of the run; entries that arrive later belong to the
    next run. ``high`` is the maximum over the whole index, so a scope without
    changes moves on too. ``index`` is an :class:`IndexTable`, whose record gives
    the bound and the files to open, or a DataFrame; pass the same one that the
    run should see, since its files are listed when it is made.

    Nothing is committed until :meth:`commit` is called, which is to be done once
    what was made of the feed has been stored. As a context manager the run
    commits when the block ends without an exception. A run that is given up or
    fails is repeated by the next one, so sinks should bear a repetition.

    ``since``       a snapshot to start from; a negative one means the checkpoint.
    ``force_scan``  start from 0, whatever the checkpoint.
    ``high``        the highest snapshot, if known: :func:`recorded_high`, asked for
                    before the index was read. Without it a DataFrame is scanned.
    ``failures``    a ledger of files that could not be read. Its open failures are
                    delivered along with the changes, and :meth:`report` must tell
                    how all went before the run can be committed.
    """

    def __init__(
        self,
        index: DataFrame | IndexTable,
        log: CheckpointLog,
        scope: Scope,
        app: str = DEFAULT_APP,
        version: int = DEFAULT_VERSION,
        since: int = -1,
        force_scan: bool = False,
        high: int | None = None,
        failures: FailureLedger | None = None,
    ) -> None:
        self.index = index
        self.failures = failures
        self.outcomes: DataFrame | None = None
        self._read: dict[int, DataFrame] = {}
        self.log = log
        self.scope = scope
        self.app = app
        self.version = version
        self._since = 0 if force_scan else since
        self._high = high

    @property
    def key(self) -> tuple[str, str, str, int]:
        return self.app, self.scope.kind, self.scope.key, self.version

    @cached_property
    def low(self) -> int:
        return self._since if self._since >= 0 else self.log.last_snapshot(*self.key)

    @cached_property
    def _table(self) -> IndexTable:
        return self.index.frozen()

    @cached_property
    def high(self) -> int:
        if self._high is not None:
            return self._high
        return self._table.high() if isinstance(self.index, IndexTable) else latest_snapshot(self.index)

    def _index(self, low: int) -> DataFrame:
        """The index, or what of it can hold entries of the scope in ``(low, high]``."""
        if not isinstance(self.index, IndexTable):
            return self.index
        if low not in self._read:
            part = {}
            if isinstance(self.scope, FolderScope):
                part["phrase" if self.scope.mode == "phrase" else "prefix"] = self.scope.folder
            self._read[low] = self._table.read(low, self.high, **part)
        return self._read[low]

    def entries(self) -> DataFrame:
        """Index entries of the run, with ``lin`` for ordering and paging."""
        return matching_entries(self._index(self.low), self.scope, self.low, self.high)

    @cached_property
    def owed(self) -> DataFrame:
        """Open failures that the snapshot range does not bring anyway."""
        again = (F.col("snapshot") > self.low) & (F.col("snapshot") <= self.high)
        rows = self.failures.open(*self.key).where(~F.coalesce(again, F.lit(False)))
        return rows.select("path", "snapshot", "change_types")

    def changes(self) -> DataFrame:
        """The change feed of the run, with the open failures of earlier ones if there is a ledger."""
        feed = to_feed(self.entries())
        return feed.unionByName(self.owed) if self.failures else feed

    def new_files(self) -> DataFrame:
        return new_files(self.changes())

    def deleted_files(self) -> DataFrame:
        return deleted_files(self.changes())

    def all_files(self) -> DataFrame:
        """Additions after snapshot 0 and up to ``high``, whatever the checkpoint."""
        return all_files(self._index(0), self.scope, self.high)

    def documents(self) -> DataFrame:
        return document_feed(self.changes())

    def report(self, outcomes: DataFrame) -> None:
        """Tell how the files of the run went: ``path, snapshot, ok, error``."""
        self.outcomes = outcomes

    def commit(self) -> bool:
        """Record ``high`` for the scope; tells if that moved the checkpoint.

        With a ledger the failures are recorded first. A run that ends in between
        is repeated and finds them in its range.
        """
        if self.failures:
            if self.outcomes is None:
                raise ValueError("report the outcomes first: failed files would be lost")
            self.failures.record(*self.key, self.changes(), self.outcomes)
        return self.log.commit(*self.key, self.high)

    def consume(self, function: Callable[[DataFrame], Any]) -> Any:
        """Hand the changes to ``function`` and commit once that has returned."""
        return consumed(function, self.changes(), self.commit)

    def __enter__(self) -> IncrementalRun:
        self.low, self.high  # noqa: B018  fixes the bounds before anything is read
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()
