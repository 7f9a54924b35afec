"""Chat formatting: conversations through a compiled template, and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches
from .template import compile_template

#: The production template. Only the text of an assistant is to be generated.
TEMPLATE = (
    '{% for message in messages %}<turn role="{{ message.role|escape }}">\n'
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text|escape }}{% endgeneration %}"
    "{% else %}{{ message.text|escape }}{% endif %}</turn>\n{% endfor %}"
)
#: Characters after which a piece of a formatted conversation ends (at a turn's end).
PIECE_CHARS = 1 << 20

_CONTROL = re.compile(r'\\|<(?=/?turn)|"(?=>)')
_TURN = re.compile(r'<turn role="(.*?)">\n(.*?)</turn>\n', re.S)


def escape(text: object) -> str:
    r"""Breaks up control strings: ``\`` doubles, and ``<`` of a tag or ``"`` before ``>`` gets one after it."""
    return _CONTROL.sub(lambda m: m[0] + "\\", "" if text is None else str(text))


def unescape(text: str) -> str:
    r"""Undoes :func:`escape`: of two ``\`` one stays, one alone goes."""
    return re.sub(r"\\(\\?)", r"\1", text)


PIECES = "conv_id long, piece_no long, text string, loss array<struct<start:long,end:long>>"
PIECES_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece_no", pa.int64()),
        ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def format_conversations(
    turns: DataFrame, template: str = TEMPLATE, piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """Every conversation as text, in pieces, with the spans a model is to produce.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are
    left out. A row of the result is a piece of a conversation: ``piece_no``
    counts from 0, a piece ends with a turn, and all of a conversation's pieces in order are its
    text. ``loss`` are code point spans within the piece. Rows of one
    conversation go by turn (null first), then role, then text; repeated rows are
    repeated turns. A null text or role is empty; rows with a null ``conv_id``
    are one conversation with a null id. No turns, no rows.

    Conversations are sorted by Spark and rendered as they stream by, so that
    a task holds one piece, however long a conversation is.
    """
    compile_template(template, {"escape": escape})  # a wrong one fails here, not in a task

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        render = compile_template(template, {"escape": escape})
        for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
            text: list[str] = []
            loss: list[dict[str, int]] = []
            size = piece_no = 0
            messages = ({"role": role or "", "text": body or ""} for _, role, body in rows)
            for part, marked in render(messages):
                text.append(part)
                if marked:
                    loss.append({"start": size, "end": size + len(part)})
                size += len(part)
                if size >= piece_chars and part.endswith("</turn>\n"):
                    yield conv_id, piece_no, "".join(text), loss
                    text, loss, size, piece_no = [], [], 0, piece_no + 1
            if text or not piece_no:
                yield conv_id, piece_no, "".join(text), loss

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(pieces(batches), PIECES_ARROW, weight=lambda row: len(row[2]))

    return (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(work, PIECES)
    )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of a formatted piece, unescaped."""
    for turn in _TURN.finditer(text):
        yield unescape(turn[1]), unescape(turn[2])


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


DIGESTS_ARROW = pa.schema(
    [
        (name, pa.string() if kind == "string" else pa.int64())
        for name, kind in (column.split() for column in DIGESTS.split(", "))
    ]
)


def conversation_digests(pieces: DataFrame, in_order: bool = False) -> DataFrame:
    """What can be read back from formatted conversations, one row each.

    ``pieces`` comes from :func:`format_conversations`; ``in_order`` says that it
    comes from there directly and is neither stored nor shuffled since.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
            turns, lost = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = formatted = 0
            for _, text, loss in rows:
                formatted += len(text)
                for role, body in read_turns(text):
                    turns.update(f"{role}\n{body}\n".encode())
                    n_turns += 1
                for span in loss:
                    body = unescape(text[span["start"] : span["end"]])
                    lost.update(body.encode())
                    loss_chars += len(body)
            yield conv_id, n_turns, turns.hexdigest(), loss_chars, lost.hexdigest(), formatted

    if not in_order:
        pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece_no")
    return pieces.select("conv_id", "text", "loss").mapInArrow(
        lambda batches: in_batches(read(batches), DIGESTS_ARROW), DIGESTS
    )
