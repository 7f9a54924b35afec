"""Near-duplicate documents by min-max hashing of five-word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, blocks, buffers, cut, cut_counted, in_batches, keyed, only_rows_of, utf8, word_bounds
from .components import components

#: Words of a shingle, and the percentage of a union that two sets must share.
SHINGLE, SIMILAR = 5, 75
#: Permutations; each gives a minimum and a maximum.
PERMUTATIONS = 192
#: Values of a band: 32 bands of minima and 32 of maxima. Two sets that share 75
#: of 100 shingles are in no bucket together with a chance of some 2 in a million.
ROWS = 6
#: Partners of one document that one task confirms; those of a hot one are dealt out.
PARTNERS = 512

#: Bits of a sketch, of which each is that of a minimum or maximum under another
#: permutation. Sets that share 75 of 100 differ in 256 of them on average, with a
#: deviation of 15; what differs in more than five deviations beyond that is not compared.
SKETCH, APART = 2048, 331

_draw = np.random.default_rng(404)
_A = _draw.integers(0, 1 << 31, max(PERMUTATIONS, SKETCH // 2), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _draw.integers(0, 1 << 32, len(_A), dtype=np.uint32)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of every text of a block."""
    data = _LOWER[data]
    starts, ends, of = word_bounds(offsets, data)
    words = Rolling(data).of(starts, ends)
    n = len(offsets) - 1
    first = np.searchsorted(of, np.arange(n + 1))
    runs = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        runs = runs * _STEP + words[k : len(words) - SHINGLE + 1 + k]
    runs ^= runs >> np.uint64(31)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    runs ^= runs >> np.uint64(29)
    out = []
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:  # a short text is one shingle, and no part of a longer one
            value = int(b - a)
            for word in words[a:b].tolist():
                value = (value * 0xD6E8FEB86659FD93 + word) % (1 << 64)
            out.append(np.array([value ^ 0x5555], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def min_max(shingles: np.ndarray, n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of the shingles under each of ``n`` permutations."""
    low = np.full(n, 0xFFFFFFFF, np.uint32)
    high = np.zeros(n, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 1024):
        values = x[None, at : at + 1024] * _A[:n, None]
        values += _B[:n, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band is part of the key."""
    values = np.concatenate([low, high]).astype(np.uint64).reshape(-1, ROWS)
    keys = np.arange(1, len(values) + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    for k in range(ROWS):
        keys = (keys ^ values[:, k]) * _STEP
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


_PARTS = [f"s{i}" for i in range(SKETCH // 64)]


def sketches(texts: DataFrame) -> DataFrame:
    """``rep`` and a sketch of ``SKETCH`` bits, as 64-bit numbers, of every text."""
    schema = pa.schema([("rep", pa.int64()), *((name, pa.int64()) for name in _PARTS)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                drawn = [np.concatenate(min_max(x, SKETCH // 2)) for x in shingle_sets(*buffers(block.column("text")))]
                bits = (np.array(drawn, np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(31)
                words = np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([block.column("rep"), *map(pa.array, words.T.copy())], schema=schema)

    return utf8(texts, "rep").mapInArrow(work, "rep long, " + ", ".join(f"{name} long" for name in _PARTS))


SIGNED = "doc_id long, key long, n_shingles long, set_a long, set_b long, bands array<long>"
_SIGNED = pa.schema(
    [(x, pa.int64()) for x in ("doc_id", "key", "n_shingles", "set_a", "set_b")] + [("bands", pa.list_(pa.int64()))]
)


def signatures(docs: DataFrame) -> DataFrame:
    """Size and 128-bit hash of every document's set, and its band keys (none for an empty set)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                sets = shingle_sets(*buffers(block.column("text")))
                bands = [band_keys(*min_max(x)) if len(x) else np.zeros(0, np.int64) for x in sets]
                place = np.cumsum([0, *map(len, bands)])
                columns = [
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)),
                    pa.array(
                        np.array([(x * x | np.uint64(1)).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
                    ),
                    pa.ListArray.from_arrays(pa.array(place, pa.int32()), pa.array(np.concatenate(bands))),
                ]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("key"), *columns], schema=_SIGNED
                )

    return utf8(keyed(docs), "doc_id", "key").mapInArrow(work, SIGNED)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= SIMILAR * (len(x) + len(y) - common)


_LINKED = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) of classes whose full sets are similar enough.

    ``texts`` has ``rep`` and ``text``. A document with many partners is dealt out
    to several tasks, each with a copy of its text; a task holds that one set and
    reads the partners one after another.
    """
    many = pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / PARTNERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    dealt = pairs.join(many, "a").select("a", "b", part)
    partners = dealt.join(texts, dealt["b"] == texts["rep"]).select("a", "part", "b", "text")
    heads = (
        many.join(texts, many["a"] == texts["rep"])
        .select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")
        .select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for block in blocks(batch):
                    sets = shingle_sets(*buffers(block.column("text")))
                    names = (block.column(x).to_pylist() for x in ("a", "part", "b"))
                    yield from zip(*names, sets, strict=True)

        def links() -> Iterator[tuple]:
            for _, group in groupby(rows(), key=lambda row: row[:2]):
                heads = []  # one, unless rows share an id but not a text
                for a, _, b, other in group:
                    if b is None:
                        heads.append(other)
                    elif any(similar(own, other) for own in heads):
                        yield a, b

        return in_batches(links(), _LINKED)

    return (
        partners.unionAll(heads)
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        .withColumn("text", F.col("text").cast("binary"))
        .mapInArrow(work, "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``n_shingles``, ``component_id`` and ``kept``, a row per document.

    Two documents are linked if their sets of five-word shingles share 75 of 100
    (lower-cased A-Z; fewer than five words are one shingle; no words, no links).
    A component's smallest ``doc_id`` names it and is kept.

    Documents with one set are one class, represented by the smallest id. Classes
    meet in the buckets of the bands; in a bucket each is compared with the
    smallest id there, first with the one that it shares most buckets with. What
    these comparisons have not brought into one component is then held against
    each other by longer sketches, and compared if these do not rule a link out,
    so that a large group of copies costs a comparison or two a document. Links are
    confirmed on full sets. A pair at the limit is missed by its bands with a chance
    of some 2 in a million, and ruled out by its sketches with one of some 0.6 in a
    million (more than ``APART`` of ``SKETCH`` independent bits); more alike, less.

    Null and empty texts form no links; rows with a null id form none
    either (each is its own component, named null, and kept); repeated rows are alike;
    rows that share an id but not a text are compared each for itself; an empty table gives an empty one. Other columns are left out.
    """
    signed = cut(signatures(docs), "neardup-sets")
    sets = ["set_a", "set_b", "n_shingles"]
    named = signed.where("n_shingles > 0 and doc_id is not null")
    classes = cut(
        named.groupBy(*sets)
        .agg(F.min(F.struct("doc_id", "key")).alias("least"), F.first("bands").alias("bands"))
        .select(*sets, F.col("least.doc_id").alias("rep"), F.col("least.key").alias("rep_key"), "bands"),
        "neardup-classes",
    )
    bands = classes.select(F.explode("bands").alias("band"), "rep", F.col("n_shingles").alias("n"))
    shared = bands.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("head"), F.count("*").alias("size")).where("size > 1")
    members = cut(bands.join(shared.select("band", "head"), "band"), "neardup-buckets")
    fits = f"100 * least(n, other) >= {SIMILAR} * greatest(n, other)"
    stars, n_stars = cut_counted(
        members.where("rep <> head.rep")
        .select(F.col("head.rep").alias("a"), F.col("rep").alias("b"), "n", F.col("head.n").alias("other"))
        .where(fits)
        .groupBy("a", "b")
        .agg(F.count("*").alias("together")),
        "neardup-stars",
    )
    none = signed.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).limit(0)
    links = none
    if n_stars:
        texts = _texts(docs, members.select("rep"), classes)
        first = stars.groupBy("b").agg(F.max_by("a", F.struct("together", -F.col("a"))).alias("a")).select("a", "b")
        links = cut(confirmed(first, texts), "neardup-links")
        comps = components(links)
        rest = _apart(stars.join(first, ["a", "b"], "left_anti").select("a", "b"), comps)
        links = cut(links.unionAll(confirmed(rest, texts)), "neardup-links")
        comps = components(links)
        own = F.coalesce("comp", "rep")
        placed = members.join(comps, members["rep"] == comps["id"], "left").select("band", "rep", "n", own.alias("comp"))
        mixed = placed.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
        apart = cut(placed.join(mixed.select("band"), "band"), "neardup-mixed")
        drawn = cut(sketches(texts.join(apart.select("rep").distinct(), "rep", "left_semi")), "neardup-sketches")
        # a pair that meets in several buckets is made in the first of them; classes
        # of one id and size count as one here, as they do in the join with sketches
        of_rep = apart.groupBy("rep", "n").agg(F.collect_set("band").alias("own"))
        # columns that cannot be null keep the join's condition short enough to be compiled
        drawn = drawn.select("rep", *(F.coalesce(s, F.lit(0)).alias(s) for s in _PARTS))
        apart = apart.join(of_rep, ["rep", "n"]).join(drawn, "rep")
        x = apart.withColumnRenamed("rep", "a").withColumnRenamed("comp", "comp_a")
        y = apart.select(
            "band", F.col("rep").alias("b"), F.col("n").alias("other"), F.col("comp").alias("comp_b"), F.col("own").alias("own_b"), *(F.col(s).alias(f"o{s}") for s in _PARTS)
        )
        differ = " + ".join(f"bit_count({s} ^ o{s})" for s in _PARTS)
        once = "array_min(array_intersect(own, own_b)) = x.band"
        on = F.expr(f"x.band = y.band and a < b and comp_a <> comp_b and {fits} and {differ} <= {APART} and {once}")
        across = x.alias("x").join(y.alias("y"), on).select("a", "b").distinct()
        across = cut(across.join(stars.select("a", "b"), ["a", "b"], "left_anti"), "neardup-across")
        links = cut(links.unionAll(confirmed(across, texts)), "neardup-links")
    comps = components(links).select(F.col("id").alias("rep"), "comp")
    of_class = classes.join(comps, "rep", "left").select(*sets, F.coalesce("comp", "rep").alias("comp"))
    placed = signed.join(of_class, sets, "left").select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(F.isnotnull("doc_id"), F.coalesce("comp", "doc_id")).alias("component_id"),
    )
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _texts(docs: DataFrame, reps: DataFrame, classes: DataFrame) -> DataFrame:
    """Text of every class that is in a bucket with another."""
    wanted, n = cut_counted(
        classes.join(reps.distinct(), "rep", "left_semi").select(F.col("rep").alias("doc_id"), F.col("rep_key").alias("key")),
        "neardup-wanted",
    )
    rows = only_rows_of(keyed(docs), wanted, ["doc_id", "key"], n).dropDuplicates(["doc_id", "key"])
    return cut(rows.select(F.col("doc_id").alias("rep"), "text"), "neardup-texts")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs that are not in one component."""
    of_a = comps.select(F.col("id").alias("a"), F.col("comp").alias("comp_a"))
    of_b = comps.select(F.col("id").alias("b"), F.col("comp").alias("comp_b"))
    both = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return both.where("coalesce(comp_a, a) <> coalesce(comp_b, b)").select("a", "b")
