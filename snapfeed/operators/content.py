"""From changed files to documents, elements and outcomes.

Content is a table ``(path, content)``, or comes with the feed from
:func:`snapfeed.sources.open_changed_files`. A file that cannot be read never
stops a run: it is left out of the documents and shows up in the outcomes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..balance import balanced_join
from ..functions.text import element_category, page_text, trim_line
from ..scratch import stored
from ..sources.content_table import ContentTable
from ..sources.files import MISSING, UNREADABLE


def document_rows(read: DataFrame) -> DataFrame:
    """Documents of the rows that were read; rows without content are dropped.

    Of a file that was read in pieces each piece is a document, with ``piece_no``
    and ``first_line`` beside it.
    """
    return read.where(F.col("content").isNotNull()).select(
        F.col("content").alias("page_content"),
        F.struct(F.col("path").alias("source"), "snapshot", "change_types").alias("metadata"),
        *(name for name in ("piece_no", "first_line") if name in read.columns),
    )


def outcome_rows(read: DataFrame) -> DataFrame:
    """Outcome of each file that came with its content or its error.

    The last piece of a file tells, so that pieces need not be brought together.
    """
    last = read.where(~F.col("more")) if "more" in read.columns else read
    return last.select("path", "snapshot", F.col("error").isNull().alias("ok"), "error")


def load_documents(feed: DataFrame, content: DataFrame | ContentTable) -> DataFrame:
    """One document per changed file, the whole file as its content.

    A :class:`snapfeed.sources.ContentTable` is read where it lies, any other
    table as it comes.
    """
    if isinstance(content, ContentTable):
        return document_rows(content.join(feed))
    readable = content.where(F.col("content").isNotNull()).select("path", "content")
    return document_rows(balanced_join(feed, readable, "path", "inner"))


def load_elements(feed: DataFrame, content: DataFrame | ContentTable) -> DataFrame:
    """One document per element of each changed file."""
    return split_elements(load_documents(feed, content))


def split_elements(documents: DataFrame) -> DataFrame:
    """Each non-blank line as an element with its category and its line number in the file."""
    before = F.col("first_line") if "first_line" in documents.columns else F.lit(0)
    lines = documents.select(
        "metadata",
        before.cast("int").alias("before"),
        F.posexplode(F.split("page_content", "\n")).alias("at", "line"),
    )
    return element_rows(lines.select("metadata", (F.col("before") + F.col("at")).alias("element_no"), "line"))


def element_rows(lines: DataFrame) -> DataFrame:
    """Elements of numbered lines (``metadata``, ``element_no``, ``line``)."""
    elements = lines.withColumn("page_content", trim_line(F.col("line"))).where(
        F.col("page_content") != ""
    )
    return elements.select(
        "page_content",
        F.col("metadata")
        .withField("category", element_category(F.col("page_content")))
        .withField("element_no", F.col("element_no"))
        .alias("metadata"),
    )


def outcomes(feed: DataFrame, content: DataFrame | ContentTable) -> DataFrame:
    """One row per changed file: ``path, snapshot, ok, error``.

    A file can be read if its path has more rows than rows without content. Both
    are counted apart: the one scan reads paths only, the other only row groups
    that have nulls at all. No text is read where all files are fine, and none
    crosses the network.
    """
    content = content.read() if isinstance(content, ContentTable) else content
    rows = content.select("path", F.lit(1).alias("n"))
    empty = content.where(F.col("content").isNull()).select("path", F.lit(-1).alias("n"))
    readable = rows.union(empty).groupBy("path").agg((F.sum("n") > 0).alias("readable"))
    files = balanced_join(
        feed.select("path", "snapshot"), readable, "path", "left", unique_right=True
    )
    return files.select(
        "path",
        "snapshot",
        F.coalesce("readable", F.lit(False)).alias("ok"),
        F.when(F.col("readable").isNull(), F.lit(MISSING))
        .when(~F.col("readable"), F.lit(UNREADABLE))
        .alias("error"),
    )


def missing_files(feed: DataFrame, content: DataFrame) -> DataFrame:
    """Changed files that have no content."""
    return balanced_join(feed, content.select("path").distinct(), "path", "left_anti")


def present_files(feed: DataFrame, content: DataFrame) -> DataFrame:
    """Changed files that have content."""
    return balanced_join(feed, content.select("path").distinct(), "path", "left_semi")


def process_files(
    feed: DataFrame, process: Callable[[str], object], partitions: int | None = None
) -> DataFrame:
    """Call a function of the user's own on each path and report how it went.

    A call that raises, or returns ``False``, is an error row; the others go on.
    Runs in the executors, now and once: the outcomes are stored, and what is
    derived from them does not call the function again. Only a task that is run
    again calls it again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = []
            for path in batch["path"]:
                try:
                    errors.append("failed" if process(path) is False else None)
                except Exception as error:
                    errors.append(f"{type(error).__name__}: {error}")
            yield batch.assign(ok=[e is None for e in errors], error=errors)

    work = feed.select("path", "snapshot")
    spread = work.repartition(partitions) if partitions else work
    done = spread.mapInPandas(run, "path string, snapshot bigint, ok boolean, error string")
    return stored(done, "outcomes")


def extract_page_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with their readable text in place of the markup."""
    others = [name for name in pages.columns if name != html]
    return pages.select(*others, page_text(F.col(html)).alias("text"))
