"""Repeated byte strings across documents, by depth-limited radix passes over suffixes."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, blocks, buffers, buckets_for, cut, in_batches

#: Bytes of a string that counts as repeated, and of the digit of the first pass.
DEPTH, GRAM = 50, 24
#: Bytes of text of a chunk and of a bucket of the radix passes.
CHUNK_BYTES, BUCKET_BYTES = 3 << 20, 16 << 20
#: Window starts that are ordered at a time inside a chunk.
SEGMENT = 4 << 20
_LOW = np.uint64((1 << 24) - 1)

CHUNKS = "chunk long, n_bytes long, ids binary, sizes binary, data binary"
_CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())]
)
_DIGITS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("digits", pa.binary())])
_CODES = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("codes", pa.binary())])
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_ROWS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)
#: Bytes of a digit that are sent; its first two are also its bucket's.
_SENT = 5


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=5).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _chunks(docs: DataFrame) -> DataFrame:
    """Some megabytes of documents in a row, compressed; the unit that later passes move."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        no = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in blocks(batch, most=CHUNK_BYTES):
                offsets, data = buffers(block.column("text"))
                ids = block.column("doc_id")
                known = ~ids.is_null().to_numpy(zero_copy_only=False)
                numbers = ids.fill_null(0).to_numpy().astype(np.int64)
                yield no, len(data), pickle.dumps((numbers, known)), np.diff(offsets).tobytes(), _zip(data.tobytes())
                no += 1

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(lambda batches: in_batches(rows(batches), _CHUNKS, lambda row: len(row[4])), CHUNKS)
    )


class _Chunk:
    """The documents of a chunk, and its suffixes grouped by their first digits."""

    def __init__(self, row: dict):
        self.ids, self.known = pickle.loads(row["ids"])
        sizes = np.frombuffer(row["sizes"], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.data = np.frombuffer(_unzip(row["data"]), np.uint8)

    def suffixes(self) -> None:
        """Units: runs of suffixes whose first ``DEPTH`` bytes hold the same anchor.

        The anchor is the gram of least hash among those within the first
        ``DEPTH`` bytes, so equal strings have it in the same place. A unit has a
        gram (first digit) and the hash of all bytes that its suffixes begin with
        (second digit). Suffixes shorter than ``DEPTH`` have no unit.
        """
        data, offsets = self.data, self.offsets
        n = max(0, len(data) - DEPTH + 1)
        roll = Rolling(data)
        first, last, anchor = [], [], []
        for low in range(0, n, SEGMENT):
            high = min(n, low + SEGMENT)
            at = np.arange(low, high + DEPTH - GRAM)
            key = roll.of(at, at + GRAM)
            key = (key & ~_LOW) | (at - low).astype(np.uint64)
            width, have = DEPTH - GRAM + 1, 1
            while have < width:  # the least of ever longer stretches
                step = min(have, width - have)
                key = np.minimum(key[:-step], key[step:])
                have += step
            place = (key & _LOW).astype(np.int64) + low
            starts = np.arange(low, high)
            doc = np.searchsorted(offsets, starts, "right") - 1
            fits = (starts + DEPTH <= offsets[doc + 1]) & self.known[doc]
            new = np.ones(len(starts), bool)
            new[1:] = (place[1:] != place[:-1]) | ~fits[:-1] | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(new & fits)
            end = np.ones(len(starts), bool)
            end[:-1] = new[1:] | ~fits[1:]
            first.append(starts[begin])
            last.append(starts[np.flatnonzero(end & fits)])
            anchor.append(place[begin])
        none = np.zeros(0, np.int64)
        self.first, self.last, anchor = (np.concatenate(x) if x else none for x in (first, last, anchor))
        self.doc = np.searchsorted(offsets, self.first, "right") - 1
        gram = roll.of(anchor, anchor + GRAM, 1)
        unit = roll.of(self.first, self.last + DEPTH, 2) + (anchor - self.first).astype(np.uint64)
        self.roll = roll
        self.digits = _Digits([gram, unit], self.ids[self.doc])

    def settle(self, found: dict[int, bytes], n_buckets: int) -> None:
        """Bytes that whole units take, and the strings that only the last pass can judge."""
        code = self.digits.codes(found, n_buckets)[self.digits.of]
        code[self.ids[self.doc] > self.digits.least[self.digits.of]] = 1
        self.edges = np.zeros(len(self.data) + 1, np.int32)
        whole = code == 1
        self._cover(self.first[whole], self.last[whole] + DEPTH)
        part = np.flatnonzero(code == 2)
        lengths = self.last[part] - self.first[part] + 1
        starts = np.repeat(self.first[part] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        owners = self.ids[np.repeat(self.doc[part], lengths)]
        again = Rolling(self.data, 5) if len(starts) else self.roll
        both = [self.roll.of(starts, starts + DEPTH, 3), again.of(starts, starts + DEPTH, 4)]
        self.starts, self.owners, self.strings = starts, owners, _Digits(both, owners)

    def finish(self, found: dict[int, bytes], n_buckets: int) -> Iterator[tuple]:
        """The result's rows, with what the last pass says."""
        known = self.strings.codes(found, n_buckets)[self.strings.of] == 1
        known |= self.owners > self.strings.least[self.strings.of]
        self._cover(self.starts[known], self.starts[known] + DEPTH)
        gone = np.cumsum(self.edges[:-1]) > 0
        for i, named in enumerate(self.known.tolist()):
            a, b = self.offsets[i : i + 2]
            raw, cut_out = self.data[a:b], gone[a:b]
            begins = np.diff(np.concatenate([[False], cut_out]).astype(np.int8)) == 1
            digest = hashlib.sha256(raw[~cut_out].tobytes()).hexdigest()
            yield int(self.ids[i]) if named else None, len(raw), int(cut_out.sum()), int(begins.sum()), digest

    def _cover(self, starts: np.ndarray, ends: np.ndarray) -> None:
        np.add.at(self.edges, starts, 1)
        np.add.at(self.edges, ends, -1)


class _Digits:
    """Equal digits of a chunk once, with the smallest document that has them."""

    def __init__(self, digits: list[np.ndarray], ids: np.ndarray):
        order = np.lexsort((ids, *reversed(digits)))
        ranked = [x[order] for x in digits]
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in ranked])
        lead = np.flatnonzero(new)
        self.digits = [x[lead] for x in ranked]
        self.least = ids[order][lead]
        self.of = np.empty(len(order), np.int64)  # each one's place among the distinct
        self.of[order] = np.cumsum(new) - 1

    def rows(self, chunk: int, n_buckets: int) -> Iterator[tuple[int, int, bytes]]:
        """Bucket, chunk and packed digits; a bucket is the most significant part."""
        for bucket, place in self._places(n_buckets):
            packed = [np.ascontiguousarray(x[place].view(np.uint8).reshape(-1, 8)[:, :_SENT]).tobytes() for x in self.digits]
            # ids by their first bytes, second bytes and so on, which compresses well
            ids = self.least[place].view(np.uint8).reshape(-1, 8).T.tobytes()
            yield bucket, chunk, b"".join([len(place).to_bytes(8), *packed, ids])

    def codes(self, found: dict[int, bytes], n_buckets: int) -> np.ndarray:
        """What the passes say of the distinct digits."""
        out = np.zeros(len(self.least), np.uint8)
        for bucket, place in self._places(n_buckets):
            if bucket in found:
                out[place] = np.frombuffer(found[bucket], np.uint8)
        return out

    def _places(self, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        buckets = ((self.digits[0] >> np.uint64(48)) * np.uint64(n_buckets) >> np.uint64(16)).astype(np.int64)
        edges = np.searchsorted(buckets, np.arange(n_buckets + 1))
        for bucket in np.unique(buckets).tolist():
            yield bucket, np.arange(edges[bucket], edges[bucket + 1])


def _unpack(table: pa.Table, n: int) -> tuple[list[np.ndarray], np.ndarray, list[int]]:
    digits: list[list[np.ndarray]] = [[] for _ in range(n)]
    least, sizes = [], []
    for raw in table.column("digits").to_pylist():
        size = int.from_bytes(raw[:8])
        for k in range(n):
            wide = np.zeros((size, 8), np.uint8)
            wide[:, :_SENT] = np.frombuffer(raw, np.uint8, _SENT * size, 8 + _SENT * size * k).reshape(-1, _SENT)
            digits[k].append(wide.view(np.uint64).ravel())
        planes = np.frombuffer(raw, np.uint8, 8 * size, 8 + _SENT * size * n).reshape(8, size)
        least.append(np.ascontiguousarray(planes.T).view(np.int64).ravel())
        sizes.append(size)
    return [np.concatenate(x) for x in digits], np.concatenate(least), sizes


def _coded(table: pa.Table, codes: np.ndarray, sizes: list[int]) -> pa.Table:
    parts = [x.tobytes() for x in np.split(codes, np.cumsum(sizes)[:-1])]
    columns = [table.column("chunk").combine_chunks(), table.column("bucket").combine_chunks(), pa.array(parts, pa.binary())]
    return pa.table(columns, schema=_CODES)


def _unit_codes(table: pa.Table) -> pa.Table:
    """Of every unit: 1 if a smaller document has all of it, 2 if it may have a part.

    Groups of one gram are split by the next digit. Of each distinct unit the
    smallest document stands for all; where a group has several, their suffixes
    go to the last pass.
    """
    (gram, unit), ids, sizes = _unpack(table, 2)
    order = np.lexsort((ids, unit, gram))
    g, u, d = gram[order], unit[order], ids[order]
    new_g = np.ones(len(order), bool)
    new_g[1:] = g[1:] != g[:-1]
    new_u = new_g.copy()
    new_u[1:] |= u[1:] != u[:-1]
    least = d[np.flatnonzero(new_u)]  # of every distinct unit
    of_u = np.cumsum(new_u) - 1
    of_g = np.cumsum(new_g) - 1
    heads = np.flatnonzero(new_g[new_u])
    low, high = np.minimum.reduceat(least, heads), np.maximum.reduceat(least, heads)
    several = np.diff(np.append(heads, len(least))) > 1
    code = np.where(d > least[of_u], 1, np.where(several[of_g] & (low[of_g] < high[of_g]), 2, 0)).astype(np.uint8)
    out = np.empty(len(order), np.uint8)
    out[order] = code
    return _coded(table, out, sizes)


def _window_codes(table: pa.Table) -> pa.Table:
    """Of every string of ``DEPTH`` bytes: 1 if a smaller document has it."""
    digits, ids, sizes = _unpack(table, 2)
    order = np.lexsort((ids, digits[1], digits[0]))
    a, b, d = digits[0][order], digits[1][order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(order), np.uint8)
    out[order] = d > least
    return _coded(table, out, sizes)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, a row per document.

    A byte goes if it is covered by a string of ``DEPTH`` bytes that also starts in
    a document with a smaller ``doc_id``. ``n_spans`` counts the maximal runs that
    go; the digest is of the bytes that stay, in order.

    The suffixes of all documents are put in order by their first ``DEPTH`` bytes
    only, most significant digits first, and a group that lies in one document is
    not looked at further. The first digit is the gram of least hash in those
    bytes and stands for a run of some 18 suffixes; the second is all that the
    suffixes of a run begin with, and settles whole runs; the last is the string
    itself, for the edges of what is repeated. Each chunk of documents sends a
    digit once, with the smallest document that has it, so that a common passage
    costs a row per chunk. Texts are moved, compressed, once before each later pass.

    A null or empty text has no bytes; rows with a null id neither lose bytes nor
    take any from others; rows of one id are no smaller than each other; an empty
    table gives an empty one. Other columns are left out.
    """
    chunks = cut(_chunks(docs), "repeats-chunks")
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = min(1 << 16, buckets_for(total, BUCKET_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                    chunk = _Chunk(row)
                    chunk.suffixes()
                    yield from chunk.digits.rows(row["chunk"], n_buckets)

        return in_batches(rows(), _DIGITS, lambda row: len(row[2]))

    ddl = "bucket int, chunk long, digits binary"
    codes_ddl = "chunk long, bucket int, codes binary"
    units = chunks.mapInArrow(send, ddl).groupBy("bucket").applyInArrow(_unit_codes, codes_ddl)
    units = cut(units, "repeats-units")

    def settled(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, _Chunk, dict]]:
        found: tuple[dict, dict] = {}, {}
        for bucket, codes in zip(right.column("bucket").to_pylist(), right.column("codes").to_pylist(), strict=True):
            found[bucket < 0][abs(bucket + (bucket < 0))] = codes  # those of strings count from -1 down
        for row in left.to_pylist():
            chunk = _Chunk(row)
            chunk.suffixes()
            chunk.settle(found[0], n_buckets)
            yield row["chunk"], chunk, found[1]

    def send_strings(left: pa.Table, right: pa.Table) -> pa.Table:
        return _as_table(
            (x for no, chunk, _ in settled(left, right) for x in chunk.strings.rows(no, n_buckets)), _DIGITS
        )

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        return _as_table((x for _, chunk, found in settled(left, right) for x in chunk.finish(found, n_buckets)), _ROWS)

    by_chunk = chunks.groupBy("chunk")
    strings = by_chunk.cogroup(units.groupBy("chunk")).applyInArrow(send_strings, ddl)
    strings = cut(strings.groupBy("bucket").applyInArrow(_window_codes, codes_ddl), "repeats-strings")
    codes = units.unionAll(strings.withColumn("bucket", -1 - F.col("bucket")))
    return by_chunk.cogroup(codes.groupBy("chunk")).applyInArrow(finish, RESULT)


def _as_table(rows: Iterator[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches(list(in_batches(rows, schema)), schema)
