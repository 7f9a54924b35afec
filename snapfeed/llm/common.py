"""What the operators share: words, tables that cut lineage, views of Arrow buffers."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_dir

#: A word is a run of characters other than blank, tab, line feed, vertical tab,
#: form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a task works on at a time; longer texts form a block alone.
BLOCK_BYTES = 4 << 20

#: Largest table of ids that is sent to every task, in rows. Beyond it the same
#: join shuffles.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    stored = cut(df, label)
    return stored, stored.count()


def only_rows_of(df: DataFrame, ids: DataFrame, keys: list[str], n_ids: int) -> DataFrame:
    """Rows of ``df`` whose keys are among ``ids``: by broadcast up to a checked size."""
    return df.join(F.broadcast(ids) if n_ids <= BROADCAST_ROWS else ids, keys, "left_semi")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``key``, which equal rows have in common."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "text")


def free(names: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores as make it differ from ``names``."""
    taken = {name.lower() for name in names}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` and key are not in ``gone``; their columns alone, whatever their names."""
    own, g_id, g_key = free(docs.columns, "own_key", "g_id", "g_key")
    listed, n = cut_counted(gone.select(F.col("doc_id").alias(g_id), F.col("key").alias(g_key)).distinct(), "gone")
    listed = F.broadcast(listed) if n <= BROADCAST_ROWS else listed
    mine = docs.withColumn(own, F.xxhash64("doc_id", "text"))
    same = (F.col(own) == F.col(g_key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(g_id))
    return mine.join(listed, same, "left_anti").select(*docs.columns)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(df: DataFrame, *others: str, text: str = "text") -> DataFrame:
    """The named columns and the text as UTF-8 bytes; null stays null."""
    return df.select(*others, F.col(text).cast("binary").alias(text))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a binary column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    place = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    place = place.astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return place - place[0], whole[place[0] : place[-1]]


def blocks(batch: pa.RecordBatch, text: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of at most ``most`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    offsets, _ = buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def in_batches(
    rows: Iterable[tuple], schema: pa.Schema, weight: Callable[[tuple], int] | None = None, most: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Rows as batches of 1,000, or fewer if their weights come to ``most``."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(columns, schema.types, strict=True)], schema=schema
        )

    for row in rows:
        held.append(row)
        size += weight(row) if weight else 0
        if len(held) >= 1000 or size >= most:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of a block, and the text that it is in."""
    is_word = np.zeros(len(data) + 1, bool)
    np.logical_not(_BLANK[data], out=is_word[:-1])
    before = np.zeros(len(data) + 1, bool)
    before[1:] = is_word[:-1]
    before[offsets] = False  # a word ends where its text ends
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(len(data) + 1, bool)
    after[:-1] = is_word[1:]
    after[-1] = False
    inner = offsets[offsets > 0] - 1
    after[inner] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_PRIME = np.uint64(0x9E3779B97F4A7C15)
_ROOT = 0xD6E8FEB86659FD93  # odd, so powers can be undone modulo 2**64
_UNROOT = pow(_ROOT, -1, 1 << 64)
_BYTE = np.random.default_rng(20240501).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + np.uint64((salt * 0xA0761D6478BD642F + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(32)
    x *= _PRIME
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        np.multiply(out[:more], np.uint64(pow(base, have, 1 << 64)), out=out[have : have + more])
        have += more
    return out


class Rolling:
    """64-bit hashes of any byte ranges of a block, from one pass over it."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        n = len(data)
        letters = mix(_BYTE.copy(), seed) if seed else _BYTE
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(letters[data] * _powers(_ROOT, n), out=self.sums[1:])
        self.undo = _powers(_UNROOT, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        """Equal bytes have equal hashes, wherever they stand."""
        plain = (self.sums[ends] - self.sums[starts]) * self.undo[starts]
        return mix(plain + (ends - starts).astype(np.uint64) * _PRIME, salt)


def tasks_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(n: int, per_bucket: int) -> int:
    return max(1, math.ceil(n / per_bucket))
