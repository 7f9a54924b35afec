"""Overlapping word chunks of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_words

# Words per chunk, words shared with the chunk before, and the
# longest chunk in characters.
CHUNK_WORDS = 300
CHUNK_OVERLAP = 10
CHUNK_MAX_CHARS = 5000


def chunk_words(
    documents: DataFrame,
    size: int = CHUNK_WORDS,
    overlap: int = CHUNK_OVERLAP,
    max_chars: int = CHUNK_MAX_CHARS,
    text: str = "page_content",
) -> DataFrame:
    """Cut each text into chunks of ``size`` words that share ``overlap`` words.

    Chunks start every ``size - overlap`` words until one reaches the end of the
    text; a text without words has none. A chunk over ``max_chars`` characters is
    cut into consecutive pieces. Gives the other columns of the document and
    ``chunk_no``, ``piece_no`` (both from 0) and ``chunk``. No shuffle.
    """
    check_sizes(size, overlap, max_chars)
    stride = size - overlap
    others = [name for name in documents.columns if name != text]

    # A text without words has a null here, which explode() drops. A filter would
    # be moved below the projection and split every text a second time.
    words = documents.select(*others, split_words(F.col(text)).alias("_words"))
    last_chunk = F.ceil(F.greatest(F.size("_words") - size, F.lit(0)) / stride).cast("int")
    numbers = F.when(F.size("_words") > 0, F.sequence(F.lit(0), last_chunk))
    chunks = words.select(*others, "_words", F.explode(numbers).alias("chunk_no")).select(
        *others,
        "chunk_no",
        F.array_join(F.slice("_words", F.col("chunk_no") * stride + 1, F.lit(size)), " ").alias(
            "_chunk"
        ),
    )
    return capped(chunks, others, max_chars)


def check_sizes(size: int, overlap: int, max_chars: int) -> None:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    if max_chars < 1:
        raise ValueError("max_chars must be at least 1")


def capped(chunks: DataFrame, others: list[str], max_chars: int) -> DataFrame:
    """Chunks (``_chunk``) in pieces of at most ``max_chars`` characters."""
    last_piece = F.floor((F.length("_chunk") - 1) / max_chars).cast("int")
    return chunks.select(
        *others,
        "chunk_no",
        "_chunk",
        F.explode(F.sequence(F.lit(0), last_piece)).alias("piece_no"),
    ).select(
        *others,
        "chunk_no",
        "piece_no",
        F.substring("_chunk", F.col("piece_no") * max_chars + 1, F.lit(max_chars)).alias("chunk"),
    )
