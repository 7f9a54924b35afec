"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, cut_counted, free, in_batches, n_words

#: Weights by the code point order of the sources (null last), repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: Most times that a document is taken.
MOST_COPIES = 3
#: Documents of a leaf of the reduction tree, and residuals of an inner node.
LEAF, FAN = 4096, 64
#: Fractions nearer than this to 0 or 1 are first brought together in pairs.
NEAR = 1 / 16


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of every source in ``sizes`` (``source``, ``size``).

    The sources share all words by weight. None gets over ``most`` times its own
    words; the excess goes to the others by weight until none is above. Works by
    one small aggregate per round and never brings the sources to the driver.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    cycle = list(weights)
    rows = ranked.map(lambda x: (x[0][0], int(x[0][1]), cycle[x[1] % len(cycle)]))
    shares = cut(spark.createDataFrame(rows, "source string, source_size long, weight double"), "mix-sources")

    capped, level = -1, 0.0
    while True:
        full = F.col("source_size") * most < F.col("weight") * level
        row = shares.agg(
            F.sum("source_size"),
            F.sum(F.when(full, F.col("source_size") * most)),
            F.sum(F.when(~full, F.col("weight"))),
            F.count(F.when(full, 1)),
        ).first()
        words, taken, free = row[0] or 0, row[1] or 0, row[2] or 0.0
        if row[3] == capped or not free:
            break
        capped, level = row[3], (words - taken) / free
    target = F.least(F.col("source_size") * float(most), F.col("weight") * level)
    return shares.select("source", "source_size", target.cast("double").alias("target"))


#: A row on its way through the tree.
NODE = "key long, source string, size long, doc_id long, copies int, p double, decided boolean"
_ARROW = pa.schema(
    [
        ("key", pa.int64()),
        ("source", pa.string()),
        ("size", pa.int64()),
        ("doc_id", pa.int64()),
        ("copies", pa.int32()),
        ("p", pa.float64()),
        ("decided", pa.bool_()),
    ]
)


def _coin(seed: int, a: int, b: int) -> float:
    """A number in [0, 1) that depends on its arguments alone."""
    return int.from_bytes(hashlib.blake2b(f"{seed}:{a}:{b}".encode(), digest_size=7).digest()) / (1 << 56)


def _whole(p: float) -> float:
    """``p``, or 0 or 1 if it is that but for rounding."""
    return float(round(p)) if min(p, 1 - p) < 1e-9 else p


def _pair(a: list, b: list, seed: int) -> None:
    """Moves words between two fractions until one of them is integral."""
    (a_key, a_size, p), (b_key, b_size, q) = a[:3], b[:3]
    up = min((1 - p) * a_size, q * b_size)  # words that may move from b to a
    down = min(p * a_size, (1 - q) * b_size)
    moved = up if _coin(seed, a_key, b_key) * (up + down) < down else -down  # 0 in the mean
    a[2], b[2] = _whole(p + moved / a_size), _whole(q - moved / b_size)


def _against_rest(rows: list[list], i: int, seed: int) -> bool:
    """Decides row ``i`` by its own coin; the rows after it make up for the words.

    Each row gives way as far as it can in either direction, so that its mean is
    kept whatever the coin shows. False, and nothing done, if the rest is too small.
    """
    key, size, p = rows[i][:3]
    left, shares = float(size), []
    for j in range(i + 1, len(rows)):
        q, b_size = rows[j][2], rows[j][1]
        if 0 < q < 1:
            share = min(left, b_size * min(q / (1 - p), (1 - q) / p))
            shares.append((j, share))
            left -= share
            if left <= 1e-9 * size:
                break
    else:
        return False
    taken = _coin(seed, key, size) < p
    for j, share in shares:
        change = -share * (1 - p) if taken else share * p
        rows[j][2] = _whole(rows[j][2] + change / rows[j][1])
    rows[i][2] = float(taken)
    return True


def _is_open(row: list) -> bool:
    return 0 < row[2] < 1


def _pairs(rows: list[list], seed: int, near: float = 0.5) -> None:
    """Pairs the open rows whose fraction is within ``near`` of 0 or 1, each with what the last pair left of them."""
    held = None
    for row in rows:
        if not 0 < min(row[2], 1 - row[2]) <= near:
            continue
        if held is not None:
            _pair(row, held, seed)
        left = next((x for x in (row, held) if x is not None and _is_open(x)), None)
        held = left if left is not None and min(left[2], 1 - left[2]) <= near else None


def pivot(rows: list[list], seed: int) -> None:
    """Makes the fractions of ``rows`` integral, all but one at most.

    A row is [key, size, p, …], large ones first, and its ``p`` is changed in
    place. Words (``p`` times ``size``) move between two sides in a direction
    drawn so that every ``p`` keeps its mean, until one side is integral; the
    words of all together stay the same. Fractions near 0 or 1 are paired with
    their neighbours until they are no longer. Then a document is paired with
    those after it together, a few dozen at most, so that what is left fractional
    in the end is small; when they are too few for that, with the next one alone.
    """
    _pairs(rows, seed, NEAR)
    at = 0
    while at < len(rows) and (not _is_open(rows[at]) or _against_rest(rows, at, seed)):
        at += 1
    _pairs(rows[at:], seed)


def _level(rows: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: each node keeps at most one undecided row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

        def out() -> Iterator[tuple]:
            for _, group in groupby(rows_of(), key=lambda row: (row[1], row[6])):
                left: list[list] = []
                # equal rows share a node; many of them are worked off in parts
                while part := list(islice(group, 4 * LEAF)):
                    rows = left + [[key, size, p, source, doc_id, copies] for key, source, size, doc_id, copies, p, _ in part]
                    pivot(rows, seed)
                    left = [row for row in rows if 0 < row[2] < 1]
                    yield from (settled(row, True) for row in rows if not 0 < row[2] < 1)
                yield from (settled(row, False) for row in left)

        def settled(row: list, decided: bool) -> tuple:
            key, size, p, source, doc_id, copies = row
            return key, source, size, doc_id, copies + int(p) * decided, p, decided

        return in_batches(out(), _ARROW)

    return (
        rows.repartition("source", "node")
        .sortWithinPartitions("source", "node", F.desc("size"), "key")
        .select("key", "source", "size", "doc_id", "copies", "p", "node")
        .mapInArrow(work, NODE)
    )


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, seed: int = 7, leaf: int = LEAF, fan: int = FAN
) -> DataFrame:
    """What a mix of the sources takes of every document.

    ``docs`` has ``doc_id``, ``source``, ``text``. Returns ``doc_id``,
    ``source``, ``key`` (hash of the row), ``size``, ``source_size``, ``target``,
    ``copies`` and ``taken`` (words, repeats counted), a row per row of ``docs``.

    A document's number of copies is its source's target over its size: the whole
    part for certain, the fraction by pivotal rounding. A leaf of the reduction
    tree pairs some ``leaf`` documents of one source, chosen by hash so that a hot
    source has many leaves; each node hands at most one fractional document up,
    ``fan`` of which meet in the next node, and the last one of a source is
    rounded. So a source misses its target by half of one document at most, and
    mostly by half of a small one. Coins
    depend on the rows and the seed alone: a rerun takes the same.

    A null or empty text has size 0 and no copies beyond the whole part; a null
    source is a source of its own; repeated rows are rounded each for itself; an
    empty table gives an empty one. Other columns are left out.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "source", "text").alias("key"),
    )
    sizes, n = cut_counted(narrow, "mix-sizes")
    targets = cut(source_targets(sizes.select("source", "size"), weights, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12)
    # the number of sources may grow with the data, so no broadcast is forced
    begun = sizes.join(targets, _same_source(sizes, targets))
    begun = begun.select(
        "key", sizes["source"], "size", "doc_id", whole.cast("int").alias("copies"), (ratio - whole).alias("p")
    )
    open_ = (F.col("p") > 1e-12) & (F.col("size") > 0)
    nodes = max(1, -(-n // leaf))
    done = [begun.where(~open_).select("key", "source", "size", "doc_id", "copies")]
    level = begun.where(open_).withColumn("node", F.pmod("key", F.lit(nodes)))
    while True:
        level = cut(_level(level, seed), "mix-level")
        done.append(level.where("decided").select("key", "source", "size", "doc_id", "copies"))
        left = level.where("not decided")
        if nodes == 1:
            break
        nodes = -(-nodes // fan)
        level = left.withColumn("node", F.pmod(F.shiftright("key", 20), F.lit(nodes)))
    done.append(left.select("key", "source", "size", "doc_id", (F.col("copies") + F.round("p").cast("int")).alias("copies")))
    taken = reduce(DataFrame.unionAll, done)
    return taken.join(targets, _same_source(taken, targets)).select(
        "doc_id",
        taken["source"],
        "key",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _same_source(left: DataFrame, targets: DataFrame):
    return left["source"].eqNullSafe(targets["source"])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes: their columns, and ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Columns of ``docs`` with these names are replaced. Of equal rows each keeps
    its own number of copies.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    taken = mix_sources(docs, **options)
    names = [name for name in docs.columns if name.lower() not in new]
    m_id, m_key, m_no = free(names, "m_id", "m_key", "m_no")
    by = Window.partitionBy(m_id, m_key)
    right = (
        taken.select(F.col("doc_id").alias(m_id), F.col("key").alias(m_key), *new)
        .withColumn(m_no, F.row_number().over(by.orderBy("copies")))
    )
    left = (
        docs.select(*names)
        .withColumn(m_id, F.col("doc_id").cast("long"))
        .withColumn(m_key, F.xxhash64("doc_id", "source", "text"))
        .withColumn(m_no, F.row_number().over(by.orderBy(F.lit(1))))
    )
    same = (left[m_key] == right[m_key]) & (left[m_no] == right[m_no]) & left[m_id].eqNullSafe(right[m_id])
    return left.join(right, same).where("copies > 0").select(*(left[x] for x in names), *new)
