"""Scopes: a folder or a named dataset, as a condition and a checkpoint key."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import DEFAULT_ROOT, FOLDER_MODES, folder_condition, normalise_folder
from ..sources.datasets import check_predicate, dataset_predicate

# The type of an ordinary file, and the kinds of scope in a checkpoint.
REGULAR = "regular"
FOLDERS = "folder_paths"
DATASETS = "datasets"


@dataclass(frozen=True)
class FolderScope:
    """Files of a folder. Spellings of one folder share one checkpoint per mode."""

    folder: str
    mode: str = "prefix"
    root: str = DEFAULT_ROOT
    kind: str = field(default=FOLDERS, init=False)

    def __post_init__(self) -> None:
        if self.mode not in FOLDER_MODES:
            raise ValueError(f"folder mode must be one of {FOLDER_MODES}: {self.mode!r}")
        object.__setattr__(self, "folder", normalise_folder(self.folder, self.root))

    @property
    def key(self) -> str:
        """The folder; modes that match otherwise than the default one have keys of their own."""
        return self.folder if self.mode == "prefix" else f"{self.mode}:{self.folder}"

    def condition(self) -> Column:
        return folder_condition(self.folder, self.mode)


@dataclass(frozen=True)
class DatasetScope:
    """Files of a named dataset, given by a condition on index columns."""

    name: str
    predicate: str
    kind: str = field(default=DATASETS, init=False)

    def __post_init__(self) -> None:
        check_predicate(self.predicate)

    @classmethod
    def lookup(cls, definitions: DataFrame, name: str) -> DatasetScope:
        return cls(name, dataset_predicate(definitions, name))

    @property
    def key(self) -> str:
        return self.name

    def condition(self) -> Column:
        return F.expr(self.predicate)


Scope = FolderScope | DatasetScope


def make_scope(
    folder_path: str | None = None,
    dataset_name: str | None = None,
    dataset_definitions: DataFrame | None = None,
    folder_mode: str = "prefix",
) -> Scope:
    """Scope from exactly one of a folder and a dataset name."""
    if (folder_path is None) == (dataset_name is None):
        raise ValueError("give either a folder or a dataset name, and not both")
    if folder_path is not None:
        return FolderScope(folder_path, folder_mode)
    if dataset_definitions is None:
        raise ValueError("a dataset name needs the table of dataset definitions")
    return DatasetScope.lookup(dataset_definitions, dataset_name)


def is_regular() -> Column:
    return F.col("file_type") == REGULAR


def above(low: int) -> Column:
    return F.col("s2") > F.lit(low).cast("bigint")


def up_to(high: int) -> Column:
    return F.col("s2") <= F.lit(high).cast("bigint")


def scope_condition(scope: Scope, low: int | None = None, high: int | None = None) -> Column:
    """Regular files of a scope, within ``(low, high]`` where bounds are given.

    Bounds are literals, so the whole condition reaches the scan.
    """
    parts = [is_regular(), scope.condition()]
    if low is not None:
        parts.append(above(low))
    if high is not None:
        parts.append(up_to(high))
    return reduce(and_, parts)


def under_folder(index: DataFrame, folder: str, mode: str = "prefix") -> DataFrame:
    return index.where(FolderScope(folder, mode).condition())


def in_dataset(index: DataFrame, definitions: DataFrame, name: str) -> DataFrame:
    return index.where(DatasetScope.lookup(definitions, name).condition())
