"""An index with a record of its files: runs find their bounds and their files there."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..balance import range_sorted
from ..schema import INDEX_SCHEMA
from .index import with_change_list
from .phrases import PAIRS, can_prune, files_with, path_pairs
from .versions import Store, Versions

# Folders beside the entries; readers of the plain files pass over names with an underscore.
MANIFEST, SEGMENTS, PHRASES = "_manifest", "_manifest/segments", "_manifest/phrases"
# Seconds to wait for the record of a write that has just ended.
_WAITS = (0.2, 1.0, 4.0)


class IndexTable:
    """A flat index that is written and read by way of a manifest.

    Every :meth:`append` puts its files into a folder of its own, ranged on
    ``(s2, path)``, and then records them: for each file its rows, and the range
    of its snapshots and paths. A write shows as a whole or not at all. The
    newest snapshot comes from the record, and a reader is handed just the files
    that can hold what it asks for; nothing of the index is scanned or listed
    for that but the names in its top folder.

    A name there that no record has would be a gap in a run and is an error. Who
    has put files there otherwise calls :meth:`adopt`.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._store = Store(spark, self.path)
        self._versions = Versions(spark, f"{self.path}/{MANIFEST}")
        self._fixed: list[dict] | None = None

    def frozen(self) -> IndexTable:
        """The table as it is now; what is added later does not show."""
        now = IndexTable(self.spark, self.path)
        now._fixed = self.segments()
        return now

    def append(self, index: DataFrame, partitions: int | None = None) -> None:
        """Add entries; they are visible once they are recorded."""
        name = f"write={uuid.uuid4().hex}"
        range_sorted(index.select(*INDEX_SCHEMA.names), ["s2", "path"], partitions).write.parquet(f"{self.path}/{name}")
        self._record([name])

    def adopt(self) -> list[str]:
        """Record files that were put into the folder by other means; their names."""
        names, _ = self._unrecorded()
        if names:
            self._record(names)
        return names

    def _record(self, names: list[str]) -> None:
        """Measure what lies below some names and add it to the record, as one version."""
        rows = self._flat([f"{self.path}/{name}" for name in names])
        place = F.col("_metadata.file_path")
        zones = rows.groupBy(place.alias("file")).agg(
            F.count(F.lit(1)).alias("rows"),
            *(f(c).alias(f"{n}_{c}") for c in ("s2", "path") for n, f in (("low", F.min), ("high", F.max))),
        )
        files = [row.asDict() for row in zones.collect()]
        for file in files:  # as written below the table's own path
            name = next(n for n in names if f"/{n}" in file["file"])
            file["file"] = name + file["file"].rpartition(f"/{name}")[2]
        segment = f"{uuid.uuid4().hex}.json"
        self._store.put(f"{SEGMENTS}/{segment}", json.dumps(files))
        added = {"segment": segment, "names": names, "files": len(files), **_hull(files)}

        def extended(state: list[dict] | None) -> list[dict] | None:
            known = {name for other in state or [] for name in other["names"]}
            return None if known & set(names) else [*(state or []), added]

        self._versions.change(extended)

    def index_phrases(self, partitions: int | None = None) -> int:
        """Let readers of a phrase pass over files without it; how many writes were newly indexed.

        The pairs of neighbouring components in the paths of each file are written
        beside the record, for all writes that have none yet. Call it after an
        :meth:`append` when one likes: writes that are not indexed are read whole.
        """
        new = [segment for segment in self.segments() if "phrases" not in segment]
        if not new:
            return 0
        names = [name for segment in new for name in segment["names"]]
        below = "|".join(f"\\Q{name}\\E" for name in names)
        place = F.regexp_extract(F.col("_metadata.file_path"), f"^.*/((?:{below})(?:/.*)?)$", 1)
        paths = self._flat([f"{self.path}/{name}" for name in names]).select("path", place.alias("file"))
        phrases = f"write={uuid.uuid4().hex}"
        pairs = range_sorted(path_pairs(paths), ["parent", "low"], partitions)
        pairs.write.parquet(f"{self.path}/{PHRASES}/{phrases}")
        written = {segment["segment"] for segment in new}

        def marked(state: list[dict] | None) -> list[dict] | None:
            mine = [s["segment"] in written and "phrases" not in s for s in state]
            changed = [{**s, "phrases": phrases} if own else s for s, own in zip(state, mine, strict=True)]
            return changed if any(mine) else None

        self._versions.change(marked)
        return len(new)

    def _with_phrase(self, phrase: str, writes: set[str]) -> set[str]:
        """Of the files indexed by some writes of :meth:`index_phrases`, those that can hold a phrase."""
        pairs = self.spark.read.schema(PAIRS).parquet(*(f"{self.path}/{PHRASES}/{name}" for name in sorted(writes)))
        return {row.file for row in files_with(pairs, phrase).collect()}

    def _flat(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(INDEX_SCHEMA).option("recursiveFileLookup", "true").parquet(*paths)

    def _unrecorded(self) -> tuple[list[str], list[dict]]:
        """Names in the top folder that are in no record and not just being written, and what is recorded."""
        names = self._store.names()  # first: what ends in between is recorded then
        segments = self._versions.read()[1] or []
        known = {name for segment in segments for name in segment["names"]}
        others = [name for name in names if name[0] not in "_." and name not in known]
        return [n for n in others if not n.startswith("write=") or self._store.exists(f"{n}/_SUCCESS")], segments

    def segments(self) -> list[dict]:
        """What was recorded, an entry per write; an error if there is more in the folder."""
        if self._fixed is not None:
            return self._fixed
        for wait in (*_WAITS, None):
            others, segments = self._unrecorded()
            if not others:
                return segments
            if wait is None:
                raise ValueError(f"{self.path} holds what nobody has recorded, see IndexTable.adopt: {sorted(others)[:5]}")
            time.sleep(wait)

    def high(self) -> int:
        """Highest snapshot, -1 if there is none."""
        return max((s["high_s2"] for s in self.segments() if s["high_s2"] is not None), default=-1)

    def files(
        self, low: int | None = None, high: int | None = None, prefix: str = "", phrase: str = ""
    ) -> list[str]:
        """Files that can hold entries with ``low < s2 <= high`` and paths that begin with ``prefix``.

        With ``phrase`` also those alone whose paths can hold that text, as far as
        :meth:`index_phrases` has gone over them.
        """
        segments = [segment for segment in self.segments() if overlapping(segment, low, high, prefix)]
        indexed = {s["phrases"] for s in segments if "phrases" in s} if can_prune(phrase) else set()
        holding = self._with_phrase(phrase, indexed) if indexed else set()
        found = []
        for segment in segments:
            text = self._store.read(f"{SEGMENTS}/{segment['segment']}")
            if text is None:
                raise ValueError(f"{self.path} has lost a part of its record: {segment['segment']}")
            files = [zone["file"] for zone in json.loads(text) if overlapping(zone, low, high, prefix)]
            found += [file for file in files if segment.get("phrases") not in indexed or file in holding]
        return found

    def read(
        self, low: int | None = None, high: int | None = None, prefix: str = "", phrase: str = ""
    ) -> DataFrame:
        """Entries of the files that can hold what is asked for, and only these are opened."""
        files = [f"{self.path}/{file}" for file in self.files(low, high, prefix, phrase)]
        if not files:
            return with_change_list(self.spark.createDataFrame([], INDEX_SCHEMA))
        return with_change_list(self.spark.read.schema(INDEX_SCHEMA).parquet(*files))

    def check(self) -> None:
        """Compare all files below the folder with the record; an error names what one side lacks."""
        self.segments()
        recorded = set(self.files())
        listed = self._flat([self.path]).inputFiles() if recorded else []
        base = len(self.path.rpartition("/")[2]) + 1
        found = {file[file.index(f"/{self.path.rpartition('/')[2]}/") + base + 1 :] for file in listed}
        if found != recorded:
            raise ValueError(f"files and record of {self.path} differ: {sorted(found ^ recorded)[:5]}")


def overlapping(zone: dict, low: int | None, high: int | None, prefix: str = "") -> bool:
    """Whether a file (or what was written with it) can hold an entry of a range of snapshots and paths."""
    if low is not None and (zone["high_s2"] is None or zone["high_s2"] <= low):
        return False
    if high is not None and (zone["low_s2"] is None or zone["low_s2"] > high):
        return False
    if not prefix:
        return True
    return zone["low_path"] is not None and zone["low_path"][: len(prefix)] <= prefix <= zone["high_path"]


def _hull(files: list[dict]) -> dict:
    def of(column: str, f) -> dict:
        values = [file[column] for file in files if file[column] is not None]
        return {column: f(values) if values else None}

    return of("low_s2", min) | of("high_s2", max) | of("low_path", min) | of("high_path", max)
