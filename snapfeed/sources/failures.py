"""Files that a run could not read, kept until a later run can."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..balance import balanced_join
from ..functions.changes import ENTRY_ADDED, ENTRY_DELETED, has_change
from .checkpoints import CheckpointLog
from .files import MISSING
from .versions import Store, Versions

FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("snapshot", T.LongType()),
        T.StructField("change_types", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)
# Tables of a key that are left for readers when a newer one has come.
_BEHIND = 2

Key = tuple[str, str, str, int]


class FailureLedger:
    """Open failures of each application, scope and version; the keys are those of the checkpoints.

    An open failure is an entry of the feed, ``(path, snapshot)``, whose file could
    not be read, with the error and the number of attempts. :meth:`record` merges
    the outcomes of a run into it: failures are opened or counted on, what was
    read is closed, what was not tried stays. Each key has one table of its open
    failures, named by a versioned state; a writer that comes second starts over
    from what the first one has left.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, key: Key) -> str:
        return f"{self.path}/{CheckpointLog._name(*key)}"

    def _versions(self, key: Key) -> Versions:
        return Versions(self.spark, f"{self._folder(key)}/_state")

    def _table(self, key: Key, state: list[str] | None) -> DataFrame:
        if not state:
            return self.spark.createDataFrame([], FAILURE_SCHEMA)
        return self.spark.read.schema(FAILURE_SCHEMA).parquet(f"{self._folder(key)}/{state[0]}")

    def open(self, app: str, kind: str, scope: str, version: int) -> DataFrame:
        """Open failures of a key: ``path, snapshot, change_types, error, attempts``."""
        key = (app, kind, scope, version)
        return self._table(key, self._versions(key).read()[1])

    def record(self, app: str, kind: str, scope: str, version: int, feed: DataFrame, outcomes: DataFrame) -> None:
        """Merge what became of the entries of a feed.

        A file that is missing because it was deleted owes nothing. To record the same
        outcomes again, as after a run that came no further, changes nothing but
        the number of attempts.
        """
        key = (app, kind, scope, version)
        versions = self._versions(key)
        number, state = versions.read()
        while True:
            name = f"open-{uuid.uuid4().hex}"
            merged(self._table(key, state), feed, outcomes).write.parquet(f"{self._folder(key)}/{name}")
            names = [name, *(state or [])]
            if versions.store.put(versions._name(number + 1), _text(names[: _BEHIND + 1])):
                break
            number, state = versions.read()
        versions.trim()
        store = Store(self.spark, self._folder(key))
        for old in names[_BEHIND + 1 :]:
            store.remove(old)


def _text(names: list[str]) -> str:
    return "[" + ", ".join(f'"{name}"' for name in names) + "]"


def merged(owed: DataFrame, feed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Open failures after a run: of ``owed`` and of the feed, by the outcomes of what was tried."""
    failed = outcomes.where(~F.col("ok") & F.col("path").isNotNull())
    failed = failed.groupBy("path", "snapshot").agg(F.min("error").alias("error"))
    entries = feed.select("path", F.col("snapshot").alias("of"), "change_types")
    kinds = F.array_distinct(F.flatten(F.sort_array(F.collect_set("change_types"))))
    same = F.col("snapshot").eqNullSafe(F.col("of"))
    named = balanced_join(failed, entries, "path", "inner").where(same)
    named = named.groupBy("path", "snapshot", "error").agg(kinds.alias("change_types"))
    gone = has_change(ENTRY_DELETED) & ~has_change(ENTRY_ADDED) & (F.col("error") == MISSING)
    again = named.where(~F.coalesce(gone, F.lit(False)))
    before = owed.select(F.col("path").alias("p"), F.col("snapshot").alias("s"), F.col("attempts").alias("had"))
    on = (F.col("path") == F.col("p")) & F.col("snapshot").eqNullSafe(F.col("s"))
    attempts = (F.coalesce("had", F.lit(0)) + 1).alias("attempts")
    again = again.join(before, on, "left").select("path", "snapshot", "change_types", "error", attempts)
    tried = outcomes.select("path", F.col("snapshot").alias("of"))
    tried = balanced_join(owed.select("path", "snapshot"), tried, "path", "inner").where(same)
    tried = tried.select(F.col("path").alias("p"), F.col("snapshot").alias("s")).distinct()
    return again.unionByName(owed.join(tried, on, "left_anti"))
