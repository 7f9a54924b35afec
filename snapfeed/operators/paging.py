"""Total order of index entries and reading them page by page."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..balance import MIN_ROWS, range_sorted
from ..scratch import scratch_dir

# Fixed value: entries per page unless the caller says otherwise.
DEFAULT_PAGE_SIZE = 10_000

ORDER = ("lin", "path", "s2")

# Rows that a summary of ``lin`` tells apart.
_ACCURACY = 100_000

# monotonically_increasing_id() keeps the row position in the lower bits.
_POSITION_BITS = 33


def ordered(entries: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Entries by ``lin``, then path and snapshot."""
    return range_sorted(entries, list(ORDER), min_rows=min_rows)


def _key(lin: Column, path: Column) -> Column:
    """A value that sorts as the pair does, null before all others."""
    return F.struct(F.isnotnull(lin), lin, F.isnotnull(path), path)


def page_after(
    entries: DataFrame,
    last: tuple[int | None, str | None] | None = None,
    size: int = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """The ``size`` entries that follow the key ``(lin, path)`` of the last one seen.

    Entries that share ``lin`` and
    path are told apart by neither key, so a page is filled up to the end of its
    last key; that way no page border loses a row. Null keys come first, as in
    :func:`ordered`, and may be the last ones seen.
    """
    own = _key(F.col("lin"), F.col("path"))

    def key_of(lin: int | None, path: str | None) -> Column:
        return _key(F.lit(lin).cast("bigint"), F.lit(path).cast("string"))

    rest = entries
    if last is not None:
        rest = entries.where(own > key_of(*last))
        if last[0] is not None:  # a plain range, which reaches the scan
            rest = rest.where(F.col("lin") >= F.lit(last[0]).cast("bigint"))
    rest = _front(rest, size)
    found, end = _border(rest, size)
    if not found:
        return rest.limit(0)
    if end is not None:
        rest = rest.where(own <= key_of(*end))
    return rest.orderBy(*ORDER)


def _border(entries: DataFrame, size: int, min_rows: int = MIN_ROWS) -> tuple[int, tuple | None]:
    """Number of entries, and the key of the one that is ``size``-th in order, if there are more.

    The keys are sorted as consecutive ranges, and stored with their places in
    these. The counts of the ranges tell which one holds the entry looked for, so
    that no task sees more than one range, however many entries share a number.
    """
    table = scratch_dir(entries.sparkSession, "page-keys")
    keys = range_sorted(entries.select("lin", "path"), ["lin", "path"], min_rows=min_rows)
    keys.withColumn("_row", F.monotonically_increasing_id()).write.parquet(table)
    rows = entries.sparkSession.read.schema("lin bigint, path string, _row bigint").parquet(table)
    part = F.shiftright("_row", _POSITION_BITS).cast("int")
    counts = sorted(rows.groupBy(part.alias("part")).count().collect())
    before = 0
    for number, count in counts:
        if size <= before + count:
            place = (number << _POSITION_BITS) + size - before - 1
            border = rows.where(F.col("_row") == place).select("lin", "path").first()
            return sum(row["count"] for row in counts), tuple(border)
        before += count
    return before, None


def _front(entries: DataFrame, size: int) -> DataFrame:
    """Entries up to a ``lin`` that is certain to take in the first ``size`` of them.

    The bound is a quantile from bounded summaries per task. A summary errs by at
    most one row in ``_ACCURACY``, a small part of what is taken beyond ``size``.
    Each pass leaves about a page or a 4,096th of the rows.
    """
    shares = [4.0**-k for k in range(7)]
    while True:
        quantiles = F.percentile_approx("lin", shares, _ACCURACY)
        found = entries.agg(F.count("lin").alias("rows"), quantiles.alias("bounds")).first()
        fitting = [i for i, share in enumerate(shares) if found["rows"] * share >= 2 * size]
        if found["rows"] <= 16 * size or not fitting or not fitting[-1]:
            return entries
        bound = found["bounds"][fitting[-1]]
        if bound >= found["bounds"][0]:  # one value holds nearly all
            return entries
        entries = entries.where(F.col("lin").isNull() | (F.col("lin") <= F.lit(bound).cast("bigint")))


def number_pages(
    entries: DataFrame, size: int = DEFAULT_PAGE_SIZE, min_rows: int = MIN_ROWS
) -> DataFrame:
    """All entries with their position in the total order and their page, from 0.

    One range shuffle serves every page. The sorted entries are written once, as
    positions must not move afterwards; what is added per range is one number,
    the count of entries in the ranges before it.
    """
    spark = entries.sparkSession
    columns = entries.columns
    table = scratch_dir(spark, "pages")
    row_id = F.monotonically_increasing_id()
    ordered(entries, min_rows).withColumn("_row", row_id).write.parquet(table)

    rows = spark.read.schema(_with_row(entries)).parquet(table)
    part = F.shiftright("_row", _POSITION_BITS).cast("int")
    counts = sorted(rows.groupBy(part.alias("part")).count().collect())
    starts = [0, *accumulate(row["count"] for row in counts)][: len(counts)]
    listed = pa.table(
        {
            "_part": pa.array([row["part"] for row in counts], pa.int32()),
            "_start": pa.array(starts, pa.int64()),
        }
    )
    offsets = F.broadcast(spark.createDataFrame(listed))
    within = F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1).cast("bigint"))
    return (
        rows.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn("position", F.col("_start") + within)
        .select(*columns, "position", F.floor(F.col("position") / size).alias("page"))
    )


def _with_row(entries: DataFrame):
    return entries.withColumn("_row", F.lit(0).cast("bigint")).schema
