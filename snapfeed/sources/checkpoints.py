"""Checkpoints: how far an application got in a scope.

The checkpoint of a key is the maximum over its commits. A stale or concurrent
writer can neither move a checkpoint back nor overwrite another key.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CHECKPOINT_SCHEMA
from .versions import Store, Versions

KEY = ("app", "kind", "scope", "version")
NO_SNAPSHOT = -1
# Folder of a key's versions; Spark's readers pass over such names unless they are told.
_STATE = "_state"


def current_checkpoints(log: DataFrame) -> DataFrame:
    """Checkpoint per key; partial maxima are taken before the shuffle."""
    return log.groupBy(*KEY).agg(F.max("snapshot").alias("snapshot"))


def last_snapshot_row(
    log: DataFrame, app: str, kind: str, scope: str, version: int
) -> DataFrame:
    """One row with the checkpoint of one key, -1 if it has none.

    Another version of the same application is another key, so raising the
    version starts over.
    """
    return log.where(
        (F.col("app") == app)
        & (F.col("kind") == kind)
        & (F.col("scope") == scope)
        & (F.col("version") == version)
    ).agg(F.coalesce(F.max("snapshot"), F.lit(NO_SNAPSHOT).cast("bigint")).alias("snapshot"))


def last_snapshot(log: DataFrame, app: str, kind: str, scope: str, version: int) -> int:
    return last_snapshot_row(log, app, kind, scope, version).first().snapshot


class CheckpointLog:
    """Checkpoint log in a folder that the driver and all executors can reach.

    A key has a folder of its own, named by its hash, with one small state in
    numbered versions (:class:`Versions`): a commit puts the next one, unless
    another writer has, and the versions behind are removed in time. So a lookup
    reads one file however often was committed. Logs written before this, by a
    parquet folder per commit, are read as well, until :meth:`compact` has taken
    them up.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._store = Store(spark, self.path)

    def read(self) -> DataFrame:
        """All commits that are still there, the newest of each key among them; no rows when there was none."""
        found = [self._stored(self.path), self._states()]
        return reduce(DataFrame.unionAll, [rows for rows in found if rows is not None] or [self._nothing()])

    def _stored(self, path: str) -> DataFrame | None:
        try:
            return (
                self.spark.read.schema(CHECKPOINT_SCHEMA)
                .option("recursiveFileLookup", "true")
                .parquet(path)
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _states(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(CHECKPOINT_SCHEMA).json(f"{self.path}/key=*/{_STATE}/*.json")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _nothing(self) -> DataFrame:
        return self.spark.range(0).select(
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in CHECKPOINT_SCHEMA.fields)
        )

    @staticmethod
    def _name(app: str, kind: str, scope: str, version: int) -> str:
        key = json.dumps([app, kind, scope, version])
        return f"key={hashlib.sha256(key.encode()).hexdigest()[:32]}"

    def _folder(self, app: str, kind: str, scope: str, version: int) -> str:
        return f"{self.path}/{self._name(app, kind, scope, version)}"

    def _versions(self, *key) -> Versions:
        return Versions(self.spark, f"{self._folder(*key)}/{_STATE}")

    def current(self) -> DataFrame:
        return current_checkpoints(self.read())

    def _parquet(self, *key) -> list[str]:
        """Names of commits in the older form that may be of a key: its own, and those of no key."""
        mine = self._name(*key)
        own = [f"{mine}/{name}" for name in self._store.names(mine) if name != _STATE]
        return own + [name for name in self._store.names() if not name.startswith(("key=", "_", "."))]

    def _older(self, *key) -> int:
        """What commits in the older form say of a key."""
        while names := self._parquet(*key):
            try:
                found = [self._stored(f"{self.path}/{name}") for name in names]
                rows = reduce(DataFrame.unionAll, [rows for rows in found if rows is not None] or [self._nothing()])
                return last_snapshot(rows, *key)
            except Exception:
                if self._parquet(*key) == names:  # else they were taken into the states meanwhile
                    raise
        return NO_SNAPSHOT

    def last_snapshot(self, app: str, kind: str, scope: str, version: int) -> int:
        key = (app, kind, scope, version)
        # in this order: compact() puts a state before it removes what the state was made of
        older, (_, state) = self._older(*key), self._versions(*key).read()
        return max(older, state["snapshot"] if state else NO_SNAPSHOT)

    def commit(self, app: str, kind: str, scope: str, version: int, snapshot: int) -> bool:
        """Put the next state unless the key is already that far; tells if it wrote."""
        key = (app, kind, scope, version)
        older = self._older(*key)

        def next_state(state: dict | None) -> dict | None:
            if snapshot <= max(older, state["snapshot"] if state else NO_SNAPSHOT):
                return None
            return dict(zip(CHECKPOINT_SCHEMA.names, (*key, snapshot), strict=True))

        return self._versions(*key).change(next_state)

    def compact(self) -> None:
        """Bring every key down to its newest state, in place.

        Commits may go on meanwhile. What is in the older form is taken into the
        states first and removed only then; commits that come after the look at
        the folder are left for the next time.
        """
        top = self._store.names()
        names = [name for name in top if not name.startswith(("key=", "_", "."))]
        keys = [name for name in top if name.startswith("key=")]
        names += [f"{key}/{name}" for key in keys for name in self._store.names(key) if name != _STATE]
        if names:
            rows = self.spark.read.schema(CHECKPOINT_SCHEMA).option("recursiveFileLookup", "true")
            for row in current_checkpoints(rows.parquet(*(f"{self.path}/{name}" for name in names))).toLocalIterator():
                self._versions(*row[:4]).change(
                    lambda state, row=row: None if state and state["snapshot"] >= row.snapshot else row.asDict()
                )
            for name in names:
                self._store.remove(name)
        for key in keys:
            Versions(self.spark, f"{self.path}/{key}/{_STATE}").trim(0)

    def compact_to(self, path: str) -> CheckpointLog:
        """Write one row per key to a new log; the old one stays as it is."""
        target = CheckpointLog(self.spark, path)
        self.current().write.parquet(f"{target.path}/commit={uuid.uuid4().hex}")
        return target
