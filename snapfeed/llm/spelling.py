"""Spelling variants: words one edit apart, found over a reduced alphabet."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_batches, mix, utf8

#: Code points and occurrences that a word has at least.
LENGTH, OCCURRENCES = 5, 3
#: One in so many runs of a document loses a letter, by the checksum of both.
LOSES = 97
#: Fewest and most symbols of the reduced alphabet, and reduced words that there are for a word.
SYMBOLS, ROOM = (4, 64), 8
#: Runs that a task counts before it hands them on.
HELD = 1 << 19
#: Code points of a text that are taken at a time.
WINDOW = 1 << 20
#: Letters of words, and keys of their neighbourhoods, that are worked on at a time.
LETTERS, CELLS = 1 << 13, 1 << 17
#: Bits a key and marks of a Bloom filter, and the largest that is sent to every task.
FILTER_BITS, FILTER_MARKS, FILTER_BYTES = 16, 4, 64 << 20

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^a-zÀ-ÿ]")


def runs(text: bytes) -> Counter:
    """Runs of letters of a text, A-Z lower-cased, and how often each occurs."""
    plain = text.translate(_LOWER).decode()
    found, at = Counter(), 0
    while at < len(plain):
        gap = _GAP.search(plain, min(at + WINDOW, len(plain)))
        end = gap.start() if gap else len(plain)
        found.update(_RUN.findall(plain, at, end))
        at = end
    return found


def word_of(run: str, seed: int) -> str:
    """The run, without one letter if its checksum with the document says so."""
    h = zlib.crc32(run.encode(), seed)
    if h % LOSES:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def vocabulary(docs: DataFrame) -> DataFrame:
    """``id``, ``word``, ``n`` and ``length`` of every word of the documents, stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs(text.as_py() or b"").items():
                    if len(run) >= LENGTH and len(word := word_of(run, seed)) >= LENGTH:
                        held[word] += n
                if len(held) >= HELD:
                    yield from in_batches(held.items(), _COUNTED, weight=lambda row: len(row[0]))
                    held = Counter()
        yield from in_batches(held.items(), _COUNTED, weight=lambda row: len(row[0]))

    texts = utf8(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    words = texts.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    kept = words.where(F.col("n") >= OCCURRENCES).withColumn("length", F.length("word"))
    return cut(kept.withColumn("id", F.monotonically_increasing_id()), "spelling-words")


def symbols_for(words: DataFrame) -> int:
    """Least number of symbols that give every length ``ROOM`` times as many reduced words as it has words."""
    sizes = words.groupBy("length").count()
    root = F.ceil(F.pow(ROOM * F.col("count").cast("double"), 1 / F.col("length")))
    least = sizes.agg(F.max(root)).first()[0] or 0
    return min(max(int(least), SYMBOLS[0]), SYMBOLS[1])


def reduced(word: str, symbols: int) -> np.ndarray:
    """The symbol of each letter, from 0; letters that follow one another in the alphabet differ."""
    letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return (letters % np.uint64(symbols)).astype(np.int64)


_STEP = 0xD6E8FEB86659FD93  # odd, so that words of any length spread over 64 bits
_SIGN = mix(np.arange(SYMBOLS[1], dtype=np.uint64), 12)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.int64)


def own_key(symbols: np.ndarray) -> np.ndarray:
    """Keys of reduced words of one length, a row each; equal words have equal keys."""
    return _key((_SIGN[symbols] * _powers(symbols.shape[1])).sum(axis=1, dtype=np.uint64), symbols.shape[1])


def neighbour_keys(symbols: np.ndarray, n_symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and key of reduced words of one length, and of all that are one edit from each, each once.

    A letter of a run of equal ones is deleted once, and inserted before the run
    only. The keys come from sums before and after a place, so that a word takes
    time in proportion to its length; some places are worked on at a time.
    """
    w, n = symbols.shape
    rows = np.arange(w)
    power = _powers(n + 1)
    before = np.zeros((w, n + 1), np.uint64)
    np.cumsum(_SIGN[symbols] * power[:n], axis=1, out=before[:, 1:])
    total = before[:, -1:]
    yield rows, _key(total[:, 0], n)
    up, down = np.uint64(_STEP), np.uint64(pow(_STEP, -1, 1 << 64))
    every = np.arange(n_symbols)
    for a in range(0, n + 1, max(1, CELLS // (w * n_symbols))):
        at = np.arange(a, min(a + max(1, CELLS // (w * n_symbols)), n + 1))
        inner = at[at < n]
        own = symbols[:, inner]
        ahead = np.concatenate([np.full((w, 1), -1), symbols], axis=1)[:, at]
        fresh = own != ahead[:, : len(inner)]
        less = before[:, inner] + (total - before[:, inner + 1]) * down
        yield np.nonzero(fresh)[0], _key(less[fresh], n - 1)
        changed = total[:, :, None] + (_SIGN[None, None, :n_symbols] - _SIGN[own][:, :, None]) * power[inner][None, :, None]
        other = every[None, None, :] != own[:, :, None]
        yield np.nonzero(other)[0], _key(changed[other], n)
        more = before[:, at][:, :, None] + _SIGN[None, None, :n_symbols] * power[at][None, :, None]
        more = more + ((total - before[:, at]) * up)[:, :, None]
        other = every[None, None, :] != ahead[:, :, None]
        yield np.nonzero(other)[0], _key(more[other], n + 1)


class Filter:
    """A Bloom filter of keys: tells of most other keys that they are not among them."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(keys: np.ndarray, n_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word and bit of each of a key's marks."""
        for k in range(FILTER_MARKS):
            x = mix(keys.view(np.uint64), 77 + k)
            yield ((x >> np.uint64(6)) % np.uint64(n_words)).astype(np.int64), x & np.uint64(63)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for word, bit in self.places(keys, len(self.words)):
            out &= ((self.words[word] >> bit) & np.uint64(1)).astype(bool)
        return out


def filter_of(keys: DataFrame, n: int) -> Filter | None:
    """Filter of ``n`` keys, none if it were larger than ``FILTER_BYTES``."""
    n_words = max(1, n * FILTER_BITS // 64)
    if 8 * n_words > FILTER_BYTES:
        return None
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, bit in Filter.places(batch.column("key").to_numpy(), n_words):
                bits = (np.uint64(1) << bit).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits)], schema=schema)

    marks = keys.select("key").mapInArrow(work, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    rows = marks.toArrow()
    words = np.zeros(n_words, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Filter(words)


_KEYS = pa.schema([("id", pa.int64()), ("key", pa.int64())])


def _of_lengths(batch: pa.RecordBatch, n_symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and reduced words of a batch, those of one length together, some at a time."""
    ids = batch.column("id").to_numpy()
    words = batch.column("word").to_pylist()
    by_length: dict[int, list[int]] = {}
    for row, word in enumerate(words):
        by_length.setdefault(len(word), []).append(row)
    for length, rows in by_length.items():
        some = max(1, LETTERS // length)
        for a in range(0, len(rows), some):
            part = rows[a : a + some]
            symbols = reduced("".join(words[row] for row in part), n_symbols)
            yield ids[part], symbols.reshape(len(part), length)


def own_keys(words: DataFrame, n_symbols: int) -> DataFrame:
    """``id`` and ``key`` of every reduced word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, symbols in _of_lengths(batch, n_symbols):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(own_key(symbols))], schema=_KEYS)

    return words.select("id", "word").mapInArrow(work, "id long, key long")


def neighbourhoods(words: DataFrame, n_symbols: int, known: Filter | None) -> DataFrame:
    """``id`` and ``key`` of every reduced word's neighbourhood, without most keys that no word has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, symbols in _of_lengths(batch, n_symbols):
                for rows, keys in neighbour_keys(symbols, n_symbols):
                    if known:
                        some = known.may_hold(keys)
                        rows, keys = rows[some], keys[some]
                    if len(keys):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(keys)], schema=_KEYS)

    return words.select("id", "word").mapInArrow(work, "id long, key long")


def near_words(words: DataFrame) -> DataFrame:
    """``id``, ``near`` and ``near_n``: each word with every word one edit away.

    Words one edit apart are, letter by letter reduced to a few symbols, equal or
    one edit apart too. So the whole neighbourhood of each reduced word meets the
    reduced words, by 64-bit keys, and what meets is compared as it was written.
    What a Bloom filter of the reduced words rules out meets none and is not sent;
    where the filter would be too large to send, all of it is.
    """
    n_symbols = symbols_for(words)
    own = cut(own_keys(words, n_symbols), "spelling-keys")
    known = filter_of(own, own.count())
    others = own.withColumnRenamed("id", "other").join(words.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")), "other")
    around = neighbourhoods(words.repartition("id"), n_symbols, known)
    met = around.join(others, "key").where("id <> other").select("id", "near", "near_n")
    both = met.join(words.select("id", "word"), "id")
    return both.where(F.levenshtein("word", "near", 1) == 1).select("id", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: where the forms (``word``, ``form``) lead to in the end.

    Each round follows as many steps again as all rounds before. A form occurs at
    least twice as often as its word, so chains end and are short.
    """
    now = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.isnotnull("next").alias("moved"))
        met = cut(met, "spelling-roots")
        now = met.select("word", "root")
        if not met.where("moved").limit(1).count():
            return now


def group_spellings(docs: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``, a row per word.

    A word's form is the most frequent word one edit away (the smallest of equally
    frequent ones), if it occurs at least twice as often; the root is where the
    forms lead to. The number of symbols follows the vocabulary
    (:func:`symbols_for`), so that a reduced word stands for a word or two,
    whatever the vocabulary's size.

    Null and empty texts hold no words; an absent id counts as empty text in the
    checksum. Texts and words may be of any length: texts are read in windows, and
    keys of a word take room in proportion to its letters. Repeated rows count
    each; an empty table gives an empty result. Other columns are left out.
    """
    words = vocabulary(docs)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    most = near_words(words).groupBy("id").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = words.join(most, "id", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "best")
    is_form = -F.col("best.less") >= 2 * F.col("n")
    formed = cut(
        formed.select(
            "word", "n", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")
        ),
        "spelling-forms",
    )
    led = roots(formed.where("form is not null"))
    return formed.join(led, "word", "left").withColumn("root", F.coalesce("root", "word"))
