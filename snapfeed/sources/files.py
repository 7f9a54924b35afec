"""Content of the changed files, read where the storage is."""

from __future__ import annotations

import codecs
import errno
import re
import sys
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

from .packing import TASK_BYTES, pack_feed

MISSING = "missing"
UNREADABLE = "unreadable"

# A larger file is read as consecutive pieces of about this size, a row each.
PIECE_BYTES = 1 << 24
# Files that a task opens ahead of the one it is at, and what it reads of each meanwhile.
READ_AHEAD = 8
HEAD_BYTES = 1 << 20
# Memory of the texts that go out of a worker together; the piece that reaches it is their last.
BATCH_BYTES = 1 << 22
# Seconds to wait before the storage is asked again; after the last the task fails.
RETRY_DELAYS = (0.5, 2.0, 8.0, 30.0)

# What lies with the file itself, so that asking again would not help.
_OF_THE_FILE = {errno.EACCES, errno.EPERM, errno.EISDIR, errno.ENOTDIR, errno.ENAMETOOLONG, errno.ELOOP}


def file_uri(root: str) -> str:
    """``file:/x``, as the JVM writes it, in the form every reader takes."""
    return re.sub("^file:/(?!/)", "file:///", root)


def retried(action: Callable[[], Any], hopeless: Callable[[OSError], bool]) -> Any:
    """``action``, again after a growing delay while the storage fails."""
    for delay in (*RETRY_DELAYS, None):
        try:
            return action()
        except OSError as error:
            if delay is None or hopeless(error):
                raise
            time.sleep(delay)


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or URI, and what its paths begin with."""
    store, base = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
    return store, base.rstrip("/")


def packed_files(
    feed: DataFrame, root: str = "", task_bytes: int = TASK_BYTES, names: tuple[str, str] = ("size", "task")
) -> tuple[DataFrame, int]:
    """The feed with each file's ``size`` in bytes and the ``task`` that reads it, and how many tasks there are.

    No task reads more than ``task_bytes``, opening included, but one that reads a
    single larger file. Sizes are asked for in the executors, many at a time.
    What is no file, or not there, has a null size. Columns of these names are
    replaced; an empty feed has no tasks.
    """
    uri = file_uri(root)

    def size_of() -> Callable[[str], int | None]:
        store, base = store_of(uri)

        def ask(path: str) -> int | None:
            if path is None:
                return None
            try:
                found = retried(lambda: store.get_file_info(base + path), lambda e: e.errno in _OF_THE_FILE)
            except ValueError:  # not a path
                return None
            except OSError as error:
                if error.errno not in _OF_THE_FILE:
                    raise
                return None
            return found.size

        return ask

    return pack_feed(feed, size_of, task_bytes, names=names)


def _ahead(action: Callable[[str], Any], paths: Iterable[str], pool: ThreadPoolExecutor) -> Iterator[tuple[str, Future]]:
    """Each path with what ``action`` finds there, begun for the next few paths too."""
    waiting: deque[tuple[str, Future]] = deque()
    for path in paths:
        waiting.append((path, pool.submit(action, path)))
        if len(waiting) > READ_AHEAD:
            yield waiting.popleft()
    yield from waiting


def _border(text: str) -> int:
    """Where to cut a piece: after its last line, else its last word, else at its end."""
    return text.rfind("\n") + 1 or text.rfind(" ") + 1 or len(text)


def open_changed_files(
    feed: DataFrame,
    root: str = "",
    partitions: int | None = None,
    batch_bytes: int = BATCH_BYTES,
    piece_bytes: int = PIECE_BYTES,
    encoding: str = "utf-8",
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Read each file of a feed as text, in the executors.

    Adds ``content`` and ``error`` to every row of the feed; one of the two is
    null. ``error`` is ``missing`` or ``unreadable`` (not text of the encoding, a
    folder, forbidden); no such file fails the job. Trouble of the storage is
    another matter: the file is tried again and then fails its task, as a run
    must not pass over files that are fine. A byte-order mark is no part of the
    text. Index paths are looked up below ``root``: a folder mounted on the
    executors, or a URI such as ``s3://bucket/prefix`` or ``hdfs://name/``.

    A file larger than ``piece_bytes`` becomes one row per piece, cut after a line
    where there is one. ``piece_no`` numbers the pieces, ``first_line`` counts the
    lines before a piece, and ``more`` tells that another piece or an error
    follows. A file that turns out unreadable later on keeps the pieces before.

    The work follows the feed and not the tree: nothing is listed and nothing is
    joined. Spark's own file sources would list the whole tree on the driver and
    pass over empty files. A part of the index names far more bytes than it
    holds, so the feed is spread before reading: by bytes, up to ``task_bytes`` a
    task, for which it is stored with the files' sizes (:func:`packed_files`), or
    at random over ``partitions`` where that is given. A task begins to read the
    next ``READ_AHEAD`` files while it is at one, up to ``HEAD_BYTES`` of each.
    Output batches are cut at ``batch_bytes`` of memory, so neither large files nor
    many small ones pile up in a worker: what it holds follows the largest piece
    and not what its task reads.
    """
    names = feed.columns
    uri = file_uri(root)
    codec = "utf-8-sig" if codecs.lookup(encoding).name == "utf-8" else encoding

    def read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = store_of(uri)

        def part(path: str, offset: int, size: int) -> tuple[bytes, bool]:
            def read() -> tuple[bytes, bool]:
                with store.open_input_file(base + path) as file:
                    whole = file.size()
                    data = file.read_at(max(0, min(size, whole - offset)), offset)  # memory is taken for all that is asked
                    return data, offset + len(data) < whole

            return retried(read, of_the_file(path))

        def head(path: str) -> tuple[bytes, bool]:
            return part(path, 0, min(piece_bytes, HEAD_BYTES))

        def of_the_file(path: str) -> Callable[[OSError], bool]:
            def hopeless(error: OSError) -> bool:
                if isinstance(error, FileNotFoundError) or error.errno in _OF_THE_FILE:
                    return True
                return store.get_file_info(base + path).type == fs.FileType.Directory

            return hopeless

        def pieces(path: str, begun: Future) -> Iterator[tuple]:
            decoder = codecs.getincrementaldecoder(codec)()
            held, offset, number, lines, more = "", 0, 0, 0, True
            try:
                while more:
                    data, more = begun.result() if not offset else (b"", True)
                    if more and len(data) < piece_bytes:
                        added, more = part(path, offset + len(data), piece_bytes - len(data))
                        data += added
                    offset += len(data)
                    held += decoder.decode(data, final=not more)
                    cut = _border(held) if more else len(held)
                    if more and not cut:
                        continue
                    yield number, lines, more, held[:cut], None
                    number, lines, held = number + 1, lines + held.count("\n", 0, cut), held[cut:]
            except FileNotFoundError:
                yield number, lines, False, None, MISSING
            except (ValueError, TypeError):
                yield number, lines, False, None, UNREADABLE
            except OSError as error:
                if not of_the_file(path)(error):
                    raise
                yield number, lines, False, None, UNREADABLE

        def filled(batch: pd.DataFrame, rows: list[int], found: list[tuple]) -> pd.DataFrame:
            added = dict(zip(PIECE_COLUMNS, zip(*found, strict=True), strict=True))
            return batch.iloc[rows].assign(**{name: list(values) for name, values in added.items()})

        pool = ThreadPoolExecutor(READ_AHEAD)
        try:
            for batch in batches:
                rows, found, held = [], [], 0
                for row, (path, begun) in enumerate(_ahead(head, batch["path"], pool)):
                    for piece in pieces(path, begun):
                        rows.append(row)
                        found.append(piece)
                        held += sys.getsizeof(piece[3])
                        if held >= batch_bytes:
                            yield filled(batch, rows, found)
                            rows, found, held = [], [], 0
                if rows:
                    yield filled(batch, rows, found)
        finally:
            pool.shutdown(cancel_futures=True)

    if partitions is None:
        packed, tasks = packed_files(feed, root, task_bytes, ("_size", "_task"))
        spread = packed.repartitionById(max(1, tasks), "_task").select(*names)
    else:
        spread = feed.repartition(max(1, partitions))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.schema.fields)
    added = "piece_no int, first_line bigint, more boolean, content string, error string"
    opened = spread.mapInPandas(read_batches, f"{fields}, {added}")
    return opened.select(*names, *PIECE_COLUMNS)


PIECE_COLUMNS = ("piece_no", "first_line", "more", "content", "error")
