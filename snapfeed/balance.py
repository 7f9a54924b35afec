"""Joins and sorts that hold up when one key owns a large share of the rows.

Before joining, the narrow side is measured in one pass: its rows and bytes, the
range of its keys, and its rows per hash bucket of the key. How to join follows
from these numbers and not from estimates, which take a text column for as
small as a name.

A bucket with more than one reduce task's fair share of the rows is heavy, and
only heavy buckets are treated. There can be no more heavy buckets than reduce
tasks, so their list has a fixed bound and may be broadcast whatever the size of
the data.
"""

from __future__ import annotations

import math
from typing import Any, NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16384
# Below this many rows a bucket is no burden to one task.
MIN_ROWS = 10_000
# Equal rows travel as one row with a count of at most this many.
MAX_COPIES = 10_000
# Up to this size the narrow side is broadcast.
BROADCAST_BYTES = 64 << 20
# Up to this size per reduce task the narrow side becomes a hash table.
HASH_TABLE_BYTES = 64 << 20


class Measure(NamedTuple):
    rows: int
    bytes: int
    low: Any
    high: Any
    heavy: dict[int, int]
    tasks: int


def bucket_of(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def row_bytes(schema: T.StructType) -> Column:
    """Size of a row: text, bytes and lists of text as they are, other nested values by their JSON."""
    total = F.lit(16).cast("bigint")
    for field in schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            width = F.octet_length(column)
        elif field.dataType == T.ArrayType(T.StringType()):
            width = F.octet_length(F.array_join(column, ","))
        elif isinstance(field.dataType, T.ArrayType | T.StructType | T.MapType):
            width = F.octet_length(F.to_json(column))
        else:
            width = F.lit(8)
        total = total + 8 + F.coalesce(width, F.lit(0))
    return total


def measure(df: DataFrame, keys: list[str], min_rows: int = MIN_ROWS) -> Measure:
    """Size, range of the first key, and heavy buckets with the tasks each is worth.

    Shuffles at most one row per bucket and map task, and brings one row per
    bucket to the driver.
    """
    tasks = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), BUCKETS // 4)
    buckets = (
        df.groupBy(bucket_of(keys).alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(row_bytes(df.schema)).alias("bytes"),
            F.min(keys[0]).alias("low"),
            F.max(keys[0]).alias("high"),
        )
        .toArrow()
    )
    rows = pc.sum(buckets["rows"]).as_py() or 0
    share = max(min_rows, rows / tasks)
    loads = zip(buckets["bucket"].to_pylist(), buckets["rows"].to_pylist(), strict=True)
    return Measure(
        rows,
        pc.sum(buckets["bytes"]).as_py() or 0,
        pc.min(buckets["low"]).as_py(),
        pc.max(buckets["high"]).as_py(),
        {bucket: math.ceil(load / share) for bucket, load in loads if load > share},
        tasks,
    )


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    min_rows: int = MIN_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    unique_right: bool = False,
) -> DataFrame:
    """Equi-join of a narrow left side, whose keys may repeat, with a wide right side.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. The range of
    the left keys is put to the scan of the right side. A left side that
    measures small enough is broadcast, so that the right side is filtered where
    it is read; beyond that both sides are shuffled, the left one as a hash table
    if that fits, sorted otherwise. Rows of heavy buckets are dealt out over
    several tasks.

    ``unique_right`` tells that no key occurs twice on the right, whose rows must
    then be narrow too. What is left of it for a small left side has at most one
    row per left key and is broadcast back.
    """
    size = measure(left, [key], min_rows)
    right = right.where(F.col(key).between(F.lit(size.low), F.lit(size.high)))
    small = size.bytes <= broadcast_bytes
    if small and how == "inner" and not size.heavy:
        return F.broadcast(left).join(right, key)
    if small:
        right = right.join(F.broadcast(left.select(key)), key, "left_semi")
        if how in ("left_semi", "left_anti"):
            return left.join(F.broadcast(right.select(key).distinct()), key, how)
        if how == "left" and unique_right:
            return left.join(F.broadcast(right), key, how)
    strategy = None
    if how == "inner":
        fits = size.bytes / size.tasks <= HASH_TABLE_BYTES
        strategy = "shuffle_hash" if fits else "merge"
    if size.heavy:
        return _spread_join(left, right, key, how, size.heavy, strategy)
    return (left.hint(strategy) if strategy else left).join(right, key, how)


def _spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    heavy: dict[int, int],
    strategy: str | None,
) -> DataFrame:
    """Join with the rows of heavy buckets dealt out by salt.

    The right rows of such a bucket are repeated once per salt. The salt of a
    left row depends on its values alone, so a recomputed task deals it out the
    same way; equal rows travel in counted pieces with a salt each.
    """
    listed = pa.table({"_bucket": list(heavy.keys()), "_tasks": list(heavy.values())})
    hot = F.broadcast(
        left.sparkSession.createDataFrame(listed).select(
            F.col("_bucket").cast("int"), F.col("_tasks").cast("int")
        )
    )
    columns = left.columns
    bucketed = left.withColumn("_bucket", bucket_of([key]))
    light = bucketed.join(hot, "_bucket", "left_anti").select(
        *columns, F.lit(0).alias("_salt"), F.lit(1).alias("_copies")
    )
    dealt = fold_copies(bucketed.join(hot, "_bucket"), [*columns, "_tasks"]).select(
        *columns,
        F.pmod(F.xxhash64(*columns, "_piece"), "_tasks").cast("int").alias("_salt"),
        "_copies",
    )
    repeated = (
        right.withColumn("_bucket", bucket_of([key]))
        .join(hot, "_bucket", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_tasks", F.lit(1)) - 1)))
        .drop("_bucket", "_tasks")
    )
    spread = light.unionByName(dealt)
    joined = (spread.hint(strategy) if strategy else spread).join(repeated, [key, "_salt"], how)
    return unfold_copies(joined).drop("_salt")


def range_sorted(
    df: DataFrame, keys: list[str], partitions: int | None = None, min_rows: int = MIN_ROWS
) -> DataFrame:
    """Rows by the keys, as consecutive ranges over all tasks.

    A key that holds too many rows for one task is split by a last sort key, a
    hash of all values and of the number of the copy. Rows are numbered by
    counting equal ones, so a recomputed task numbers them the same way, and are
    single rows again when the ranges are drawn, so that each weighs what it is.
    """
    columns = df.columns
    order: list[str | Column] = list(keys)
    if measure(df, keys, min_rows).heavy:
        pieces = fold_copies(df, columns).repartition(*columns, "_piece")
        df = pieces.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
        order.append(F.xxhash64(*columns, "_piece", "_copy"))
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    return ranged.sortWithinPartitions(*order).select(*columns)


def fold_copies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Equal rows as one row per piece of at most ``MAX_COPIES`` copies."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    last_piece = F.floor((F.col("_n") - 1) / MAX_COPIES)
    return (
        counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece)))
        .withColumn(
            "_copies",
            F.least(F.lit(MAX_COPIES), F.col("_n") - F.col("_piece") * MAX_COPIES).cast("int"),
        )
        .drop("_n")
    )


def unfold_copies(df: DataFrame) -> DataFrame:
    """Equal rows one by one again, in place."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop(
        "_copy", "_copies"
    )
