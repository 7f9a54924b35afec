"""Documents, elements and chunks of files that were read in pieces.

What comes out is the same whether a file was read whole or in pieces of any
size. A file in one piece is worked on where it was read. Of the others each piece
is worked on by itself: running sums over the pieces of a file (words, lines) tell
where it stands in the file, so that only what lies across a border is sent, to be
put together from its parts. A file of which a piece could not be read gives
nothing, as if it had not been read at all.

``read`` is what :func:`snapfeed.sources.open_changed_files` gives, stored: its
rows are looked at more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import BLANKS, split_words
from ..sources.files import PIECE_COLUMNS
from .chunks import CHUNK_MAX_CHARS, CHUNK_OVERLAP, CHUNK_WORDS, capped, check_sizes, chunk_words
from .content import document_rows, element_rows, split_elements

# Files with errors that are listed to every task; beyond it the list is joined by a shuffle.
LISTED = 1_000_000


def _others(read: DataFrame) -> list[str]:
    return [name for name in read.columns if name not in PIECE_COLUMNS]


def _whole(read: DataFrame) -> DataFrame:
    """Files that were read in one piece."""
    return read.where("piece_no = 0 and not more and error is null")


def _parts(read: DataFrame) -> DataFrame:
    """Pieces of the other files, with the rest of their ``row`` and a hash of it, ``doc``."""
    rows = read.where("piece_no > 0 or more").withColumn("row", F.struct(*_others(read)))
    doc = F.sha2(F.to_json("row", {"ignoreNullFields": "false"}), 256)
    return rows.select(doc.alias("doc"), "row", *PIECE_COLUMNS)


def _good(parts: DataFrame) -> DataFrame:
    """Pieces of files that were read to their end."""
    bad = parts.where("error is not null").select("doc").distinct()
    n = bad.count()  # of errors alone, so no text is read
    if not n:
        return parts
    return parts.join(F.broadcast(bad) if n <= LISTED else bad, "doc", "left_anti")


def _together(parts: DataFrame, keys: list[str], text: str, glue: Column) -> DataFrame:
    """``text`` of the rows that share the keys, in the order of their pieces, with ``glue`` before each but the first.

    A file that is in the feed several times has its parts several times: each is
    taken once, and the result is repeated.
    """
    one = F.struct("piece_no", glue.alias("glue"), text)
    listed = F.sort_array(F.collect_set(one))
    found = parts.groupBy(*keys).agg(F.first("row").alias("row"), listed.alias("listed"), F.count(F.lit(1)).alias("n"))
    pieces = F.transform("listed", lambda x, i: F.concat(F.when(i == 0, "").otherwise(x["glue"]), x[text]))
    copies = (F.col("n") / F.size("listed")).cast("int")
    found = found.withColumn(text, F.array_join(pieces, ""))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy", "listed", "n")


def whole_documents(read: DataFrame) -> DataFrame:
    """One document per file; its pieces are put together.

    A file beyond what one cell of Spark holds (2 GiB) is an error here. Elements
    and chunks have no such limit.
    """
    joined = _together(_good(_parts(read)), ["doc"], "content", F.lit("")).select("row.*", "content")
    return document_rows(_whole(read).select(*_others(read), "content").unionByName(joined))


def element_pieces(read: DataFrame) -> DataFrame:
    """Elements of the files, as :func:`split_elements` has them of whole ones.

    A line that goes on in the next piece is put together from its parts.
    """
    lines = _good(_parts(read)).withColumn("lines", F.split("content", "\n"))
    place = F.posexplode("lines").alias("at", "line")
    lines = lines.select("doc", "piece_no", "row", "more", "first_line", F.size("lines").alias("n"), place)
    lines = lines.withColumn("element_no", (F.col("first_line") + F.col("at")).cast("int"))
    cut = (F.col("at") == 0) & (F.col("piece_no") > 0) | (F.col("at") == F.col("n") - 1) & F.col("more")
    names = ("row", "element_no", "line")
    joined = _together(lines.where(cut), ["doc", "element_no"], "line", F.lit("")).select(*names)
    found = lines.where(~cut).select(*names).unionByName(joined)
    metadata = F.struct(F.col("row.path").alias("source"), F.col("row.snapshot").alias("snapshot"), F.col("row.change_types").alias("change_types"))
    whole = split_elements(document_rows(_whole(read)))
    return whole.unionByName(element_rows(found.select(metadata.alias("metadata"), "element_no", "line")))


def chunk_pieces(
    read: DataFrame,
    size: int = CHUNK_WORDS,
    overlap: int = CHUNK_OVERLAP,
    max_chars: int = CHUNK_MAX_CHARS,
) -> DataFrame:
    """Chunks of the files' words, as :func:`chunk_words` has them of whole ones.

    Gives the other columns of ``read`` with ``chunk_no``, ``piece_no`` (of the
    chunk) and ``chunk``. A word that a border cuts is one word. A chunk that
    takes in words of several pieces gets the words that each has of it, the last
    ``overlap`` of a piece among them.
    """
    check_sizes(size, overlap, max_chars)
    stride = size - overlap
    names = _others(read)
    parts = _parts(read).where("content <> '' or error is not null")

    blank = list(BLANKS)
    inside = {"starts": F.left("content", F.lit(1)), "ends": F.right("content", F.lit(1))}
    own = parts.select(
        "doc", "piece_no", "error", F.size(split_words(F.col("content"))).cast("long").alias("n"),
        *((~x.isin(*blank)).alias(name) for name, x in inside.items()),
    ).distinct()
    before = Window.partitionBy("doc").orderBy("piece_no")
    all_of = Window.partitionBy("doc")
    own = own.withColumn("bad", F.max(F.col("error").isNotNull()).over(all_of)).where(~F.col("bad"))
    own = own.withColumn("joined", F.coalesce(F.lag("ends").over(before) & F.col("starts"), F.lit(False)))
    own = own.withColumn("goes_on", F.coalesce(F.lead("starts").over(before) & F.col("ends"), F.lit(False)))
    new = F.col("n") - F.col("joined").cast("long")  # a word cut by the border counts where it begins
    own = own.withColumn("first", F.sum(new).over(before) - F.col("n")).withColumn("total", F.sum(new).over(all_of))

    # the texts are sent once, and are cut into words where they arrive
    place = own.select("doc", "piece_no", "joined", "goes_on", "first", "total")
    both = parts.select("doc", "piece_no", "row", "content").join(place, ["doc", "piece_no"])
    both = both.withColumn("words", split_words(F.col("content"))).drop("content").withColumn("n", F.size("words").cast("long"))
    last = F.ceil(F.greatest(F.col("total") - size, F.lit(0)) / stride).cast("long")
    from_no = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("first") - size + 1) / stride).cast("long"))
    to_no = F.least(last, F.floor((F.col("first") + F.col("n") - 1) / stride).cast("long"))
    numbers = F.when((F.col("n") > 0) & (from_no <= to_no), F.sequence(from_no, to_no))
    spread = both.withColumn("chunk_no", F.explode(numbers))
    begin = F.greatest(F.col("chunk_no") * stride - F.col("first"), F.lit(0).cast("long"))
    end = F.least(F.col("chunk_no") * stride + size - F.col("first"), F.col("n"))
    spread = spread.withColumn("begin", begin.cast("int")).withColumn("end", end.cast("int"))
    had = F.array_join(F.slice("words", F.col("begin") + 1, F.col("end") - F.col("begin")), " ")
    glued = F.col("joined") & (F.col("begin") == 0)
    whole = (
        (F.col("chunk_no") * stride >= F.col("first"))
        & (F.least(F.col("chunk_no") * stride + size, F.col("total")) <= F.col("first") + F.col("n"))
        & ~glued
        & ~(F.col("goes_on") & (F.col("end") == F.col("n")))
    )
    kept = ("doc", "piece_no", "row", "chunk_no")
    spread = spread.select(*kept, had.alias("text"), glued.alias("glued"), whole.alias("whole"))
    joined = _together(spread.where(~F.col("whole")), ["doc", "chunk_no"], "text", F.when(F.col("glued"), "").otherwise(" "))
    columns = ("row", "chunk_no", "text")
    found = spread.where("whole").select(*columns).unionByName(joined.select(*columns))
    chunks = found.select("row.*", F.col("chunk_no").cast("int").alias("chunk_no"), F.col("text").alias("_chunk"))
    uncut = chunk_words(_whole(read).select(*names, "content"), size, overlap, max_chars, text="content")
    return uncut.unionByName(capped(chunks, names, max_chars))
