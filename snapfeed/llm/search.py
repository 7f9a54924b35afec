"""Ranked lexical search: the NRA method over impact-sorted lists, a shard of documents at a time."""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, utf8

#: A term is a maximal run of ASCII letters, digits and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents that an item is given.
TOP = 50
#: Bytes of item texts that are searched for in one pass over the documents.
ITEM_BYTES = 8 << 20
#: Postings of a shard, and marks (documents times terms of the longest item) beside them.
POSTINGS, MARKS = 1 << 21, 1 << 26
#: Entries of each list in the first round of reads; every round reads four times as many.
FIRST = 256
#: Bytes of a text that are split at a time.
WINDOW = 1 << 20

_FOLD = bytes(
    ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256)
)

Lists = list[tuple[np.ndarray, np.ndarray]]


def term_windows(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z lower-cased, some windows of it at a time; no term is cut."""
    plain = text.translate(_FOLD)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + WINDOW)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """Weight of terms that so many of the documents hold."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def lengths(n_terms: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """``m`` of documents of so many terms; the product is taken in whole numbers of any size."""
    different, place = np.unique(n_terms, return_inverse=True)
    values = [50 + (50 * n * n_docs) // all_terms for n in different.tolist()]
    return np.array(values, np.int64)[place]


def read_lists(lists: Lists, n_docs: int, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard that can be among the ``top``, with their scores.

    ``lists`` has the documents and impacts of each term, highest impact first.
    All lists are read from the front, round by round. ``low`` is what has been
    read of a document; a list that it was not met in yet can add at most the
    next impact there, which gives its upper bound. Reading goes on until no
    document is left whose upper bound reaches the limit (the ``top``-th lower
    bound, or ``least`` from shards before) and is not its score. What equals the
    limit stays, so that ties are settled by the caller.
    """
    low = np.zeros(n_docs, np.int64)
    unseen = np.ones((len(lists), n_docs), bool)
    ahead = np.array([impacts[0] for _, impacts in lists], np.int64)
    at, step = 0, FIRST
    while True:
        end = at + step
        for t, (docs, impacts) in enumerate(lists):
            if at < len(docs):
                read = docs[at:end]
                low[read] += impacts[at:end]
                unseen[t, read] = False
                ahead[t] = impacts[end] if end < len(docs) else 0
        limit = max(least, 1)
        if n_docs >= top:
            limit = max(limit, int(np.partition(low, n_docs - top)[n_docs - top]))
        may = np.flatnonzero(low + ahead.sum() >= limit)
        high = low[may]
        for t in np.flatnonzero(ahead):
            high = high + ahead[t] * unseen[t, may]
        may, high = may[high >= limit], high[high >= limit]
        if (high == low[may]).all():
            return may, low[may]
        at, step = end, step * 4


class Shard:
    """Documents and their postings, gathered until there are enough to rank."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.n_terms = array("q")
        self.n_found = array("q")
        self.terms = array("q")
        self.tf = array("q")

    def add(self, doc_id: int | None, n_terms: int, found: Counter) -> None:
        self.ids.append(doc_id)
        self.n_terms.append(n_terms)
        self.n_found.append(len(found))
        self.terms.extend(found.keys())
        self.tf.extend(found.values())

    def lists(self, n_docs: int, all_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, documents and impacts (without the term's weight): by term, highest first."""
        terms, tf = np.array(self.terms, np.int64), np.array(self.tf, np.int64)
        docs = np.repeat(np.arange(len(self.ids)), np.array(self.n_found, np.int64))
        m = lengths(np.array(self.n_terms, np.int64), n_docs, all_terms)[docs]
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m)
        order = np.lexsort((-impact, terms))
        return terms[order], docs[order], impact[order]


def _least_first(scored: list[tuple[int, int | None]]) -> list[tuple[int, int | None]]:
    return sorted(scored, key=lambda x: (-x[0], x[1] is None, x[1] or 0))


def _found(vocabulary: dict[bytes, int], text: bytes | None) -> tuple[int, Counter]:
    n, found = 0, Counter()
    for words in term_windows(text or b""):
        n += len(words)
        found.update(filter(None, map(vocabulary.get, words)))
    return n, found


_COUNTED = pa.schema([("id", pa.int64()), ("n", pa.int64())])
_SCORED = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
#: Rows of the counts that are no term: documents with a term, and terms of all documents.
_DOCS, _TERMS = -1, -2


def counts(texts: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """N, L, and df of every term of the vocabulary (numbered from 1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, all_terms = Counter(), 0, 0
        for batch in batches:
            for text in batch.column("text"):
                n, found = _found(vocabulary, text.as_py())
                n_docs += n > 0
                all_terms += n
                df.update(found.keys())
        yield from in_batches([(_DOCS, n_docs), (_TERMS, all_terms), *df.items()], _COUNTED)

    sums = texts.mapInArrow(work, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    of = dict(zip(sums["id"], sums["n"], strict=True))
    return of.get(_DOCS, 0), of.get(_TERMS, 0), np.array([0] + [of.get(t, 0) for t in vocabulary.values()], np.int64)


def _ranked(texts: DataFrame, items: list[tuple[int, set[bytes]]], top: int) -> DataFrame:
    """``item``, ``doc_id`` and ``score`` of what each task's documents have for each item."""
    vocabulary = {term: t for t, term in enumerate(sorted(set().union(*(terms for _, terms in items))), 1)}
    n_docs, all_terms, df = counts(texts, vocabulary)
    weight = weights(n_docs, df)
    asked = [(item, np.array(sorted(vocabulary[x] for x in terms), np.int64)) for item, terms in items if terms]
    longest = max((len(terms) for _, terms in asked), default=1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int | None]]] = {item: [] for item, _ in asked}

        def rank(shard: Shard) -> None:
            terms, docs, impact = shard.lists(n_docs, all_terms)
            for item, own in asked:
                starts, ends = np.searchsorted(terms, own), np.searchsorted(terms, own, "right")
                lists = [
                    (docs[a:b], weight[t] * impact[a:b])
                    for t, a, b in zip(own, starts, ends, strict=True)
                    if a < b and weight[t]
                ]
                if not lists:
                    continue
                held = best[item]
                least = held[-1][0] if len(held) == top else 0
                rows, scores = read_lists(lists, len(shard.ids), top, least)
                new = [(score, shard.ids[row]) for row, score in zip(rows.tolist(), scores.tolist(), strict=True)]
                best[item] = _least_first(held + new)[:top]

        shard = Shard()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text"), strict=True):
                n, found = _found(vocabulary, text.as_py())
                if not found:
                    continue
                shard.add(doc_id, n, found)
                if len(shard.tf) >= POSTINGS or len(shard.ids) * longest >= MARKS:
                    rank(shard)
                    shard = Shard()
        rank(shard)
        rows = ((item, doc_id, score) for item, held in best.items() for score, doc_id in held)
        yield from in_batches(rows, _SCORED)

    return texts.mapInArrow(work, "item long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``top`` documents of each item.

    A document's score sums, over the item's distinct terms, the term's weight
    times a saturating share of its occurrences, all in whole numbers. Documents
    are dealt to tasks as they lie; a task gathers shards of bounded size, sorts
    the lists of the items' terms by impact and reads them with lower and upper
    bounds (:func:`read_lists`). What a task has found so far is the limit for its
    next shard. A list of a frequent term is thus never in one place, and only
    ``top`` rows an item and task are shuffled, in two steps.

    Items are taken ``ITEM_BYTES`` of text at a time, so that a task holds a
    bounded vocabulary however many there are; each such group is a pass over
    the documents for the counts and one for the scores.

    Null and empty texts hold no term: such documents are in no ranking, such items
    have none. Long texts are split window by window, within a few times their own
    size. Documents of equal score go by ascending id, null last. Repeated
    documents count and are ranked one by one; a repeated item (id and text) is
    ranked once, and items that share an id but not a text each for themselves.
    Without documents or items the result is empty. Other columns are left out.
    """
    texts = utf8(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    asked = items.select("item_id", "text").where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / ITEM_BYTES))
    spark = docs.sparkSession
    found = None
    for group in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group)
        rows = utf8(mine, "item_id").toArrow()
        terms = [set().union(*term_windows(text)) for text in rows["text"].to_pylist()]
        named = spark.createDataFrame(
            pa.table({"item": pa.array(range(len(terms)), pa.int64()), "item_id": rows["item_id"]}),
            f"item long, item_id {items.schema['item_id'].dataType.simpleString()}",
        )
        scored = _ranked(texts, list(enumerate(terms)), top) if any(terms) else None
        if scored is None:
            scored = spark.createDataFrame([], "item long, doc_id long, score long")
        part = _first(scored, top).join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionAll(part)
    return found


def _first(scored: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item with their rank; first of parts of its rows, then of what these leave."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = max(1, math.isqrt(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = scored.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    place = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    few = dealt.withColumn("place", place).where(F.col("place") <= top).drop("part", "place")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return few.withColumn("rank", rank).where(F.col("rank") <= top)
