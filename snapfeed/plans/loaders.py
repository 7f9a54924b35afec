"""Loaders: the change feed as paths, as empty documents, or with content.

``load()`` begins a run and gives its DataFrame; ``commit()`` records that run
once the DataFrame has been consumed. Loading again begins the next run.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from ..operators.content import (
    load_documents,
    outcome_rows,
    outcomes,
    split_elements,
)
from ..operators.feed import document_feed
from ..operators.pieces import element_pieces, whole_documents
from ..operators.scope import make_scope
from ..sources.checkpoints import CheckpointLog
from ..scratch import stored
from ..sources.failures import FailureLedger
from ..sources.content_table import ContentTable
from ..sources.files import open_changed_files
from ..sources.manifest import IndexTable
from .run import DEFAULT_APP, DEFAULT_VERSION, IncrementalRun, consumed


class PathLoader:
    """Change feed ``path, snapshot, change_types`` of a folder or a dataset."""

    def __init__(
        self,
        index: DataFrame | IndexTable,
        log: CheckpointLog,
        folder_path: str | None = None,
        dataset_name: str | None = None,
        dataset_definitions: DataFrame | None = None,
        force_scan: bool = False,
        app_name: str = DEFAULT_APP,
        app_version: int = DEFAULT_VERSION,
        folder_mode: str = "prefix",
        high: int | None = None,
        failures: FailureLedger | None = None,
    ) -> None:
        self.failures = failures
        self.index = index
        self.log = log
        self.scope = make_scope(folder_path, dataset_name, dataset_definitions, folder_mode)
        self.force_scan = force_scan
        self.app_name = app_name
        self.app_version = app_version
        self.high = high
        self.current_run: IncrementalRun | None = None

    def run(self) -> IncrementalRun:
        self.current_run = IncrementalRun(
            self.index,
            self.log,
            self.scope,
            self.app_name,
            self.app_version,
            force_scan=self.force_scan,
            high=self.high,
            failures=self.failures,
        )
        return self.current_run

    def load(self) -> DataFrame:
        return self.run().changes()

    def commit(self) -> bool:
        if self.current_run is None:
            raise ValueError("nothing was loaded yet")
        return self.current_run.commit()

    def consume(self, function: Callable[[DataFrame], Any]) -> Any:
        """Load, hand over to ``function``, and commit once that has returned."""
        return consumed(function, self.load(), self.commit)


class DocumentLoader(PathLoader):
    """One empty document per changed file, with the file in its metadata."""

    def load(self) -> DataFrame:
        return document_feed(super().load())


class ContentLoader(PathLoader):
    """Documents with content, whole files (``single``) or their ``elements``.

    Content comes from a table ``(path, content)``, or, without one, from the
    files themselves, opened below ``root`` in the executors. In the latter case
    ``load()`` reads every file, once, into a table in the shared folder, from
    which both the documents and the outcomes are taken: they tell of one and the
    same read, and a read that fails leaves nothing to commit.

    With a ledger of ``failures`` a file that could not be read comes again with
    the next load, until it can be.
    """

    MODES = ("single", "elements")

    def __init__(
        self,
        *args,
        content: DataFrame | ContentTable | None = None,
        root: str = "",
        mode: str = "single",
        partitions: int | None = None,
        encoding: str = "utf-8",
        **kwargs,
    ) -> None:
        super().__init__(*args, **kwargs)
        if mode not in self.MODES:
            raise ValueError(f"mode must be one of {self.MODES}: {mode!r}")
        self.content = content
        self.root = root
        self.mode = mode
        self.partitions = partitions
        self.encoding = encoding
        self.read: DataFrame | None = None

    def load(self) -> DataFrame:
        self.read = None
        feed = super().load()
        if self.content is not None:
            documents = load_documents(feed, self.content)
        else:
            opened = open_changed_files(feed, self.root, self.partitions, encoding=self.encoding)
            self.read = stored(opened, "files")
            return element_pieces(self.read) if self.mode == "elements" else whole_documents(self.read)
        return split_elements(documents) if self.mode == "elements" else documents

    def outcomes(self) -> DataFrame:
        """How each file of the loaded run went; the failed ones may be kept for later."""
        if self.current_run is None or (self.content is None and self.read is None):
            raise ValueError("nothing was loaded yet")
        if self.read is not None:
            return outcome_rows(self.read)
        return outcomes(self.current_run.changes(), self.content)

    def commit(self) -> bool:
        if self.content is None and self.read is None:
            raise ValueError("nothing was loaded yet")
        if self.failures and self.current_run is not None:
            self.current_run.report(self.outcomes())
        return super().commit()
