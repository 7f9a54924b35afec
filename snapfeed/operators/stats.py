"""Statistics of elements and of runs; all are partial and final aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import file_name
from ..functions.text import UNKNOWN_CATEGORY


def element_stats(elements: DataFrame) -> DataFrame:
    """One row: number of elements, summed and mean length (0 without elements)."""
    total, length = F.count(F.lit(1)), F.coalesce(
        F.sum(F.length("page_content")), F.lit(0).cast("bigint")
    )
    return elements.agg(
        total.alias("total_elements"),
        length.alias("total_content_length"),
        F.when(total > 0, length / total).otherwise(F.lit(0.0)).alias("avg_element_length"),
    )


def elements_by_type(elements: DataFrame) -> DataFrame:
    """Elements per category; those without one count as ``Unknown``."""
    category = _metadata_or_unknown(elements, "category")
    return elements.groupBy(category.alias("category")).agg(
        F.count(F.lit(1)).alias("elements")
    )


def elements_by_source(elements: DataFrame) -> DataFrame:
    """Elements per source path, with its file name for display."""
    source = _metadata_or_unknown(elements, "source")
    counts = elements.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("elements"))
    return counts.select("source", file_name(F.col("source")).alias("file_name"), "elements")


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row: files, successes and errors of a run."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("ok")).alias("success"),
        F.count_if(~F.col("ok")).alias("errors"),
    )


def _metadata_or_unknown(elements: DataFrame, name: str) -> Column:
    if name not in elements.schema["metadata"].dataType.names:
        return F.lit(UNKNOWN_CATEGORY)
    return F.coalesce(F.col("metadata").getField(name), F.lit(UNKNOWN_CATEGORY))
