"""A stream over an :class:`IndexTable` whose offset is a snapshot.

Each micro-batch is ``(low, high]``: ``high`` is the newest snapshot that was
recorded when the batch began, and is stored in the stream's own checkpoint
before anything is read. As in a batch run, an entry that is written later with a
snapshot up to there is passed over. The offset also says how many writes were
recorded, so that a batch that is read again reads the same files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..schema import INDEX_SCHEMA
from ..sources.files import file_uri
from ..sources.index import with_change_list
from ..sources.manifest import MANIFEST, SEGMENTS, overlapping

FORMAT = "snapfeed_snapshots"
# Rows of a batch that a task hands over at a time.
_ROWS = 1 << 16


class Part(InputPartition):
    """Files of one task, and the bounds of their entries."""

    def __init__(self, files: list[str], low: int, high: int) -> None:
        self.files, self.low, self.high = files, low, high


class SnapshotReader(DataSourceStreamReader):
    def __init__(self, path: str, low: int, files_per_task: int) -> None:
        self.path, self.low, self.files_per_task = path, low, files_per_task

    def _store(self):
        from pyarrow import fs

        uri = file_uri(self.path.rstrip("/"))
        return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)

    def _recorded(self) -> list[dict]:
        """What the manifest's newest version lists, an entry per write, in the order of the writes."""
        from pyarrow import fs

        store, base = self._store()
        while True:
            listed = store.get_file_info(fs.FileSelector(f"{base}/{MANIFEST}", allow_not_found=True))
            names = [info.base_name for info in listed if info.base_name.endswith(".json")]
            if not names:
                return []
            try:
                return self._json(f"{MANIFEST}/{max(names)}")
            except FileNotFoundError:
                continue  # a newer version has come

    def _json(self, name: str) -> list[dict]:
        store, base = self._store()
        with store.open_input_stream(f"{base}/{name}") as file:
            return json.loads(file.read())

    def initialOffset(self) -> dict:
        return {"s2": self.low, "writes": 0}

    def latestOffset(self) -> dict:
        writes = self._recorded()
        high = max((w["high_s2"] for w in writes if w["high_s2"] is not None), default=self.low)
        return {"s2": max(high, self.low), "writes": len(writes)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        low, high = start["s2"], end["s2"]
        files = [
            zone["file"]
            for write in self._recorded()[: end["writes"]]
            if overlapping(write, low, high)
            for zone in self._json(f"{SEGMENTS}/{write['segment']}")
            if overlapping(zone, low, high)
        ]
        step = self.files_per_task
        return [Part(files[a : a + step], low, high) for a in range(0, len(files), step)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        store, base = self._store()
        files = ds.dataset([f"{base}/{file}" for file in partition.files], format="parquet", filesystem=store)
        within = (ds.field("s2") > partition.low) & (ds.field("s2") <= partition.high)
        columns = list(INDEX_SCHEMA.names)
        for batch in files.to_batches(columns=columns, filter=within, batch_size=_ROWS):
            if batch.num_rows:
                yield batch


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return INDEX_SCHEMA

    def streamReader(self, schema) -> SnapshotReader:
        options = self.options
        return SnapshotReader(options["path"], int(options.get("low", "-1")), int(options.get("filesPerTask", "4")))


def read_snapshot_stream(spark: SparkSession, path: str, low: int = -1, files_per_task: int = 4) -> DataFrame:
    """Entries of an :class:`IndexTable` with ``s2 > low``, snapshot by snapshot as they are recorded.

    The folder must be one that the driver's and the executors' Python reaches: a
    mounted folder, or a URI such as ``s3://bucket/prefix`` or ``hdfs://name/``.
    Hand the result to :func:`stream_changes` and :func:`write_available`.
    """
    spark.dataSource.register(SnapshotSource)
    reader = spark.readStream.format(FORMAT).option("low", low).option("filesPerTask", files_per_task)
    return with_change_list(reader.load(path))
