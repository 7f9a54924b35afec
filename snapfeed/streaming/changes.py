"""Structured Streaming form of the change feed.

Each start takes the index files that are new since the last start and ends.
Its offset is a file, not a snapshot: it fits an index that grows by files, and
unlike the batch run it also delivers an entry that turns up late with an old
snapshot. :func:`snapfeed.streaming.read_snapshot_stream` goes by snapshots
instead. For an index rewritten in place use
:class:`snapfeed.plans.IncrementalRun`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.feed import to_feed
from ..operators.scope import Scope, scope_condition
from ..schema import INDEX_SCHEMA, NESTED_INDEX_SCHEMA
from ..sources.index import flatten_index, with_change_list


def read_index_stream(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    nested: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Index entries of the files below a path, new files as they come."""
    reader = spark.readStream.format(format).schema(
        NESTED_INDEX_SCHEMA if nested else INDEX_SCHEMA
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    entries = reader.load(path)
    return flatten_index(entries) if nested else with_change_list(entries)


def stream_changes(index_stream: DataFrame, scope: Scope, low: int | None = None) -> DataFrame:
    """Change feed of a scope over streamed entries; keeps no state."""
    return to_feed(index_stream.where(scope_condition(scope, low)))


def write_available(
    feed: DataFrame,
    checkpoint: str,
    sink: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    timeout: int | None = None,
) -> None:
    """Write what is available now, then stop.

    ``sink``        a parquet folder, each row in it exactly once.
    ``each_batch``  a function of a batch and its number, called again with the
                    same number and rows if a batch has to be repeated.
    """
    if (sink is None) == (each_batch is None):
        raise ValueError("give either a sink folder or a batch function, and not both")
    writer = feed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink is not None:
        query = writer.format("parquet").outputMode("append").start(sink)
    else:
        query = writer.foreachBatch(each_batch).start()
    if query.awaitTermination(timeout) is False:
        query.stop()
        raise TimeoutError("the stream did not finish in time; start it again to go on")
