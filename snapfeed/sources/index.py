"""The file index: one entry per file, nested as delivered or flat as used."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..balance import range_sorted
from ..functions.changes import change_list
from ..schema import INDEX_SCHEMA, NESTED_INDEX_SCHEMA

# Folder beside the entries; readers pass over names that begin with an underscore.
_HIGH = "_high"


def read_index(
    spark: SparkSession, path: str | list[str], format: str = "parquet", nested: bool = True
) -> DataFrame:
    """Read index entries with the fixed schema and return them flat.

    Filters on the flat columns still reach a parquet scan of the nested form,
    since flattening only renames fields.
    """
    schema = NESTED_INDEX_SCHEMA if nested else INDEX_SCHEMA
    entries = spark.read.format(format).schema(schema).load(path)
    return flatten_index(entries) if nested else with_change_list(entries)


def flatten_index(entries: DataFrame) -> DataFrame:
    return entries.select(
        F.col("data.lin").alias("lin"),
        F.col("data.path").alias("path"),
        F.col("data.file_type").alias("file_type"),
        F.col("metadata.snapshots.s2").alias("s2"),
        change_list("data.change_types").alias("change_types"),
    )


def with_change_list(index: DataFrame) -> DataFrame:
    """A flat index with the empty list in place of an absent one."""
    return index.select(
        "lin", "path", "file_type", "s2", change_list("change_types").alias("change_types")
    )


def nest_index(index: DataFrame) -> DataFrame:
    """Flat entries in the nested form, for writing index files."""
    return index.select(
        F.struct("path", "lin", "file_type", "change_types").alias("data"),
        F.struct(F.struct("s2").alias("snapshots")).alias("metadata"),
    )


def write_index(
    index: DataFrame, path: str, partitions: int | None = None, mode: str = "errorifexists"
) -> None:
    """Write a flat index so that a snapshot range and a folder prefix both prune.

    Files are ranged on ``(s2, path)``: an incremental run opens only the files
    at the high end. ``path`` in the key also splits a snapshot that alone holds
    most of the rows, as the first load of a file system does. Appending each
    new snapshot this way (``mode="append"``) keeps the layout.

    Once the entries are there, their highest snapshot is recorded beside them,
    for :func:`recorded_high`.
    """
    spark = index.sparkSession
    range_sorted(index, ["s2", "path"], partitions).write.mode(mode).parquet(path)
    if mode == "ignore":  # nothing may have been written
        return
    new = index
    if mode == "append" and recorded_high(spark, path) is None:
        new = spark.read.schema(INDEX_SCHEMA).parquet(path)
    high = new.agg(F.coalesce(F.max("s2"), F.lit(-1).cast("bigint")).alias("snapshot")).first()
    row = spark.range(0, 1, 1, 1).select(F.lit(high["snapshot"]).cast("bigint").alias("snapshot"))
    row.write.parquet(f"{path.rstrip('/')}/{_HIGH}/write={uuid.uuid4().hex}")


def recorded_high(spark: SparkSession, path: str) -> int | None:
    """Highest snapshot that :func:`write_index` has recorded, ``None`` without a record.

    One number per write is read and nothing of the index. Ask before
    :func:`read_index`, which lists the files: what is appended in between is
    then left to the next run, and not passed over by this one. An index that
    others append to by other means has no use for the record.
    """
    try:
        rows = (
            spark.read.schema("snapshot bigint")
            .option("recursiveFileLookup", "true")
            .parquet(f"{path.rstrip('/')}/{_HIGH}")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.agg(F.max("snapshot").alias("snapshot")).first()["snapshot"]
