"""Token counts of a unigram model, by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import base64
import importlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, keyed

#: Bytes of text whose distinct pre-tokens share a trie.
TRIE_BYTES = 8 << 20
#: Depth of the trie; what a pre-token has beyond is scored by itself.
LONGEST = 4096
#: Bits for a number of tokens: more than a text has bytes.
BITS = 31
#: Rank shift of the Zipf-Mandelbrot law that gives a ranked vocabulary its probabilities.
SHIFT = 1000.0


@dataclass
class Vocabulary:
    """Pieces with costs (negative log-probabilities in millionths) and the pre-token pattern."""

    costs: dict[bytes, int]
    pattern: str


def ranked_vocabulary(path: str | None = None, shift: float = SHIFT) -> Vocabulary:
    """A vocabulary file of ``base64 rank`` lines as unigram model.

    The file gives ranks, not probabilities; those follow ``1 / (rank + shift)``.
    It has every single byte, so that any text can be cut into pieces.
    """
    public = importlib.import_module("public_tokenizers")
    ranks: dict[bytes, int] = {}
    with open(path or public.path("byte_bpe_50k.tiktoken"), "rb") as file:
        for line in file:
            piece, _, rank = line.strip().partition(b" ")
            if piece:
                ranks[base64.b64decode(piece)] = int(rank)
    norm = math.log(sum(1 / (rank + shift) for rank in ranks.values()))
    return Vocabulary({p: round((math.log(r + shift) + norm) * 1e6) for p, r in ranks.items()}, public.PATTERN)


class Counter:
    """Numbers of tokens of pre-tokens under the cheapest cut; of equal ones the one with fewest tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.longest = max(map(len, vocabulary.costs))
        # cost and number of tokens in one number, so that ties are settled by the number
        self.by_length: list[dict[bytes, int]] = [{} for _ in range(self.longest + 1)]
        for piece, cost in vocabulary.costs.items():
            self.by_length[len(piece)][piece] = (cost << BITS) + 1
        self.ends: dict[int, list[int]] = {}  # lengths of the pieces by their last byte
        for piece in vocabulary.costs:
            self.ends.setdefault(piece[-1], []).append(len(piece))
        self.ends = {byte: sorted(set(lengths)) for byte, lengths in self.ends.items()}
        self.tails: set[bytes] = {piece[-2:] for piece in vocabulary.costs if len(piece) > 1}
        self.triples: set[bytes] = {piece[-3:] for piece in vocabulary.costs if len(piece) > 2}

    def counts(self, distinct: list[bytes]) -> list[int]:
        """Tokens of each of ``distinct``.

        In sorted order the pre-tokens are the leaves and inner ends of a trie
        walked depth first: what two neighbours have in common is the path that
        stays, with the forward scores of its nodes; only nodes below are scored.
        Below ``LONGEST`` nothing is shared, and no more scores are held than the
        longest piece reaches back.
        """
        order = sorted(range(len(distinct)), key=distinct.__getitem__)
        out = [0] * len(distinct)
        best = [0]  # by depth of the path
        before = b""
        for i in order:
            word = distinct[i]
            top = word[:LONGEST]
            shared, most = 0, min(len(top), len(before))
            while shared < most and top[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :]
            self._score(word, shared, len(top), best)
            before = top
            last = best[len(top)]
            if len(word) > LONGEST:
                held = best[-self.longest :]
                for depth in range(LONGEST, len(word), LONGEST):
                    self._score(word, depth, min(depth + LONGEST, len(word)), held)
                    del held[: -self.longest]
                last = held[-1]
            out[i] = last & ((1 << BITS) - 1)
        return out

    def _score(self, word: bytes, depth: int, most: int, scores: list[int]) -> None:
        """Appends the scores of ``word`` from below ``depth`` to ``most``; those up to ``depth`` are the last of ``scores``."""
        by_length, tails, triples, ends = self.by_length, self.tails, self.triples, self.ends
        for end in range(depth + 1, most + 1):
            score = scores[-1] + by_length[1][word[end - 1 : end]]
            if end > 1 and word[end - 2 : end] in tails:
                last = 2 if end > 2 and word[end - 3 : end] not in triples else min(end, self.longest)
                for n in ends[word[end - 1]]:
                    if n > last:
                        break
                    if n > 1 and (cost := by_length[n].get(word[end - n : end])) is not None:
                        score = min(score, scores[-n] + cost)
            scores.append(score)


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])


def count_tokens(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``doc_id``, ``n_pretokens``, ``n_tokens``, ``n_bytes`` (UTF-8), a row per document.

    A text is cut into pre-tokens by the vocabulary's pattern and each into the
    pieces of highest probability together. The distinct pre-tokens of some
    megabytes of text are put in one trie, scored once per shared prefix, and
    their counts stored and added up by document. Nothing is shuffled.

    A null or empty text has no tokens; a pre-token of any length is scored whole;
    null ids and repeated rows are counted like others; an empty table gives an
    empty one. Other columns are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary or ranked_vocabulary())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        find = regex.compile(sent.value.pattern).findall
        for batch in batches:
            for block in blocks(batch, most=TRIE_BYTES):
                number: dict[str, int] = {}
                uses, sizes, n_bytes = [], [], []
                for raw in block.column("text").to_pylist():
                    tokens = find(raw.decode("utf-8", "replace")) if raw else []
                    uses.append(np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, len(tokens)))
                    sizes.append(len(tokens))
                    n_bytes.append(len(raw or b""))
                known = np.array(counter.counts([t.encode() for t in number]), np.int64)
                totals = [int(known[used].sum()) for used in uses]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, totals, n_bytes))], schema=_COUNTS
                )

    schema = "doc_id long, n_pretokens long, n_tokens long, n_bytes long"
    return keyed(docs).select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(work, schema)
