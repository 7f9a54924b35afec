"""Quality rules: statistics of every text, and an isolation forest over them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, blocks, buffers, cut, keyed, utf8, word_bounds

#: Characters counted as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
#: Base rule: fewest words, words of a window, percent of words in repeated windows.
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
#: Documents that the forest is fitted on at most, those with the lowest hash of
#: their id, and its size. The bound is a parameter of :func:`fit_forest`.
SAMPLE, TREES, SUBSAMPLE = 16384, 200, 512
#: Share of the good labelled documents that a threshold may reject.
GOOD_LOST = 0.002
#: Steps in which thresholds are tried.
STEPS = 4096

#: What the forest looks at: shares of words, characters and lines.
FEATURES = ("symbols", "dup_lines", "repeats", "capitals", "marks", "letters", "word_chars", "one_char", "echoes")

STATS = (
    "doc_id long, key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    + ", ".join(f"f_{name} double" for name in FEATURES)
)
_ARROW = pa.schema(
    [(name, pa.int64() if kind == "long" else pa.float64()) for name, kind in (x.split() for x in STATS.split(", "))]
)

_IS = {
    "symbol": np.isin(np.arange(256), list(SYMBOLS.encode())),
    "capital": np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1)),
    "mark": np.isin(np.arange(256), list(b"!?.,;:\"'()[]{}=+/\\@_~^`")),
    "letter": (np.arange(256) >= 0x80)
    | np.isin(np.arange(256), [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]),
    "lead": (np.arange(256) & 0xC0) != 0x80,
}


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(
    offsets: np.ndarray,
    data: np.ndarray,
    bounds: tuple[np.ndarray, np.ndarray, np.ndarray],
    words: np.ndarray,
    window: int = WINDOW,
) -> np.ndarray:
    """Per text, the words inside windows of ``window`` words that it has twice or more.

    ``words`` are hashes; windows that agree in them are compared as they are spelled.
    """
    starts, ends, of = bounds
    n = len(starts)
    counts = np.zeros(len(offsets) - 1, np.int64)
    if n < window:
        return counts
    # the windows of words are hashed as ranges of a sequence of word hashes
    sums, power = np.zeros(n - window + 1, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for k in range(window):
        sums = sums * power + words[k : n - window + 1 + k]
    first = np.flatnonzero(of[: n - window + 1] == of[window - 1 :])
    keys = sums[first] ^ (of[first].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(first), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = first[order[twice]]
    if not len(hit):
        return counts
    # equal hashes are confirmed on the words themselves
    groups: dict[tuple, list[int]] = {}
    raw = data.tobytes()
    for i in hit.tolist():
        spelled = tuple(raw[starts[k] : ends[k]] for k in range(i, i + window))
        groups.setdefault((int(of[i]), spelled), []).append(i)
    covered = np.zeros(n + 1, np.int64)
    for places in groups.values():
        if len(places) > 1:
            np.add.at(covered, places, 1)
            np.add.at(covered, [i + window for i in places], -1)
    return np.bincount(of[np.cumsum(covered[:-1]) > 0], minlength=len(counts))


def _block_stats(batch: pa.RecordBatch) -> pa.RecordBatch:
    offsets, data = buffers(batch.column("text"))
    n = len(offsets) - 1
    starts, ends, of = word_bounds(offsets, data)
    n_words = np.bincount(of, minlength=n)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_IS["lead"][data], out=lead[1:])
    lengths = lead[ends] - lead[starts]
    word_chars = np.bincount(of, weights=lengths, minlength=n).astype(np.int64)
    one_char = np.bincount(of[lengths == 1], minlength=n)
    symbols, capitals, marks, letters = (_sums(_IS[x][data], offsets) for x in ("symbol", "capital", "mark", "letter"))
    hashes = Rolling(data).of(starts, ends)
    repeats = repeated_words(offsets, data, (starts, ends, of), hashes)
    echo = np.zeros(len(starts), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    echoes = np.bincount(of[echo], minlength=n)
    dup_lines, lines = np.zeros(n, np.int64), np.ones(n, np.int64)
    raw = data.tobytes()
    for i in range(n):
        text = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip(b" \t\n\v\f\r")]
        lines[i] = len(text)
        dup_lines[i] = len(text) - len(set(text))
    size = np.maximum(1, np.diff(offsets))
    words = np.maximum(1, n_words)
    shares = [
        symbols / size,
        dup_lines / np.maximum(1, lines),
        repeats / words,
        capitals / size,
        marks / size,
        letters / size,
        np.log1p(word_chars / words),
        one_char / words,
        echoes / words,
    ]
    columns = [batch.column("doc_id"), batch.column("key"), *(pa.array(x.astype(np.int64)) for x in (n_words, word_chars, symbols, dup_lines, repeats))]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(x.astype(np.float64)) for x in shares)], schema=_ARROW)


def rule_statistics(docs: DataFrame) -> DataFrame:
    """Counts and shares of every whole text; a null text counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                yield _block_stats(block)

    return utf8(keyed(docs), "doc_id", "key").mapInArrow(work, STATS)


@dataclass
class Forest:
    """Trees of random splits as arrays: feature (-1 at a leaf), border, children, path length."""

    trees: list[tuple[np.ndarray, ...]]
    norm: float
    threshold: float = 2.0  # no score is above 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        """In (0, 1): the shorter the paths, the nearer to 1."""
        total = np.zeros(len(x))
        for feature, border, left, right, length in self.trees:
            at = np.zeros(len(x), np.int64)
            inner = feature[at] >= 0
            while inner.any():
                go = np.flatnonzero(inner)
                node = at[go]
                below = x[go, feature[node]] < border[node]
                at[go] = np.where(below, left[node], right[node])
                inner[go] = feature[at[go]] >= 0
            total += length[at]
        return 2.0 ** (-total / max(1, len(self.trees)) / self.norm)


def _mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n values."""
    if n <= 2:
        return float(n == 2)
    return 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow_forest(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, size)))))
    grown = []
    for _ in range(trees if size > 1 else 0):
        nodes: list[list] = []

        def grow(rows: np.ndarray, level: int, nodes=nodes) -> int:
            me = len(nodes)
            nodes.append([-1, 0.0, -1, -1, level + _mean_path(len(rows))])
            low, high = rows.min(axis=0), rows.max(axis=0)
            split = np.flatnonzero(high > low)
            if level < depth and len(rows) > 1 and len(split):
                f = int(rng.choice(split))
                border = float(rng.uniform(low[f], high[f]))
                below = rows[:, f] < border
                if below.any() and not below.all():
                    nodes[me][:2] = f, border
                    nodes[me][2] = grow(rows[below], level + 1)
                    nodes[me][3] = grow(rows[~below], level + 1)
            return me

        grow(x[rng.choice(len(x), size, replace=False)], 0)
        columns = list(zip(*nodes, strict=True))
        grown.append(tuple(np.array(c, k) for c, k in zip(columns, (int, float, int, int, float), strict=True)))
    return Forest(grown, max(1e-9, _mean_path(size)))


_F = [f"f_{name}" for name in FEATURES]


def fit_forest(stats: DataFrame, sample: int = SAMPLE, **options) -> Forest:
    """A forest of at most ``sample`` documents that pass the base rule, the lowest by hash."""
    sound = stats.where(f"n_words >= {LEAST_WORDS}").withColumn("draw", F.xxhash64("doc_id"))
    share = min(1.0, 1.5 * sample / max(1, sound.count()))  # so that tasks send few rows that are not used
    most = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    rows = sound.where(F.col("draw") <= most).orderBy("draw", "doc_id", *_F).limit(sample)
    x = np.array([tuple(row) for row in rows.select(*_F).collect()], float).reshape(-1, len(_F))
    return grow_forest(x[np.lexsort(x.T)], **options)


def score_statistics(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with ``score``."""
    sent = stats.sparkSession.sparkContext.broadcast(forest)
    schema = f"{STATS}, score double"
    arrow = _ARROW.append(pa.field("score", pa.float64()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(name).to_numpy(zero_copy_only=False) for name in _F])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.scores(x))], schema=arrow)

    return stats.mapInArrow(work, schema)


def calibrate(scored: DataFrame, labels: DataFrame, good_lost: float = GOOD_LOST) -> float:
    """The lowest of ``STEPS`` thresholds that rejects at most ``good_lost`` of the good labelled documents.

    All labelled documents that pass the base rule count. Without good ones
    nothing is rejected.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    step = F.floor(F.col("score") * STEPS).cast("int").alias("step")
    counts = (
        scored.where(f"not ({BASE_FAILED})").select("doc_id", step).join(marked, "doc_id")
        .where("quality = 1").groupBy("step").count().collect()
    )  # at most STEPS + 1 rows
    total = sum(row["count"] for row in counts)
    if not total:
        return 2.0
    above, threshold = 0, 1.0
    for row in sorted(counts, key=lambda row: -row["step"]):
        above += row["count"]
        if above > good_lost * total:
            return (row["step"] + 1) / STEPS
        threshold = row["step"] / STEPS
    return threshold


BASE_FAILED = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"


def judge_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Counts and verdict of every document.

    Returns ``doc_id``, ``key`` (hash of id and text), ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``score``, ``kept``. A
    document that fails the base rule is rejected; so is one whose statistics an
    isolation forest finds anomalous. The forest is fitted on a bounded sample
    (``SAMPLE``); its threshold comes from all labelled documents.

    A null or empty text has no words and fails the base rule; null ids and
    repeated rows are judged like others; without labels the forest rejects
    nothing; an empty table gives an empty one. Other columns are left out.
    """
    stats = cut(rule_statistics(docs), "quality-stats")
    forest = fit_forest(stats, **options)
    scored = score_statistics(stats, forest)
    threshold = calibrate(scored, labels)
    return scored.withColumn("base_failed", F.expr(BASE_FAILED)).select(
        "doc_id",
        "key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "score",
        (~F.col("base_failed") & (F.col("score") <= threshold)).alias("kept"),
    )
