"""Files dealt out to tasks by their bytes."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored

# What a task reads, unless one file is larger.
TASK_BYTES = 128 << 20
# What opening a file costs beside reading it, in bytes that could be read meanwhile.
OPEN_BYTES = 128 << 10
# Files that are packed together, and sizes asked for at the same time, in a task.
PACK_FILES = 10_000
ASKED_AT_ONCE = 16


def pack(weights: list[int], limit: int) -> list[int]:
    """Bin of each weight, bins numbered from 0: the largest first, each where it leaves least room.

    No bin goes beyond the limit but that of a single larger weight.
    """
    bins = [0] * len(weights)
    room: list[tuple[int, int]] = []  # what is left in the open bins, ascending
    used = 0
    for i in sorted(range(len(weights)), key=lambda i: -weights[i]):
        at = bisect_left(room, (weights[i], -1))
        if at < len(room):
            left, bins[i] = room.pop(at)
        else:
            left, bins[i] = limit, used
            used += 1
        if left > weights[i]:
            insort(room, (left - weights[i], bins[i]))
    return bins


def windows(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The same rows in frames of ``rows`` rows, the last one shorter."""
    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        while n >= rows:
            whole = pd.concat(held, ignore_index=True)
            yield whole.iloc[:rows].reset_index(drop=True)
            held, n = [whole.iloc[rows:]], n - rows
    if n:
        yield pd.concat(held, ignore_index=True)


def pack_feed(
    feed: DataFrame,
    size_of: Callable[[], Callable[[str], int | None]],
    task_bytes: int = TASK_BYTES,
    open_bytes: int = OPEN_BYTES,
    names: tuple[str, str] = ("size", "task"),
) -> tuple[DataFrame, int]:
    """The feed with each file's ``size`` and ``task``, and the number of tasks.

    ``size_of()`` is called in the executors and gives the function that asks for
    the size of a path (null: no such file). Files are packed where their sizes
    were asked, up to ``PACK_FILES`` together; only one count per asking task
    comes to the driver. The feed is evaluated and the storage asked once: the
    result is stored, so a task that is run again reads the same files.
    """
    size, task = names
    rest = [name for name in feed.columns if name not in names]
    feed = feed.select(*rest)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = size_of()
        part, first = TaskContext.get().partitionId(), 0
        with ThreadPoolExecutor(ASKED_AT_ONCE) as pool:
            for window in windows(batches, PACK_FILES):
                sizes = list(pool.map(ask, window["path"]))
                bins = pack([open_bytes + (n or 0) for n in sizes], task_bytes)
                window[size] = pd.array(sizes, "Int64")
                window["_part"], window["_bin"] = part, [first + b for b in bins]
                first += max(bins) + 1
                yield window

    spark = feed.sparkSession
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in feed.schema.fields)
    spread = feed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = spread.mapInPandas(measured, f"{fields}`{size}` bigint, _part int, _bin bigint")
    found = stored(asked, "packed")
    counts = found.groupBy("_part").agg((F.max("_bin") + 1).alias("n")).orderBy("_part").toArrow()
    parts, n = counts["_part"], counts["n"].to_pylist()
    offsets = pa.table({"_part": parts, "_offset": pa.array([0, *accumulate(n)][: len(n)], pa.int64())})
    numbered = found.join(F.broadcast(spark.createDataFrame(offsets)), "_part")
    number = (F.col("_offset") + F.col("_bin")).cast("int").alias(task)
    return numbered.select(*rest, size, number), sum(n)
