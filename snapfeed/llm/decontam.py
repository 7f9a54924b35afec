"""Benchmark decontamination: SimHash windows, Hamming blocks, exact confirmation. No Python in tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, cut_counted, keyed, only_rows_of

#: Words of a shingle, and the percentage of the weights of both that must agree.
SHINGLE, SIMILAR = 5, 75
#: Bits in which fingerprints of one window may differ. Windows that share 75 of 100
#: differ in 11 of 64 on average, with a deviation of 3; this is five deviations beyond.
RADIUS = 27


def words_of(text: Column) -> Column:
    """Lower-cased words; none for null."""
    words = F.split(F.coalesce(F.lower(text), F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(words, lambda word: word != "")


def _runs(values: str, n: int) -> Column:
    """Hash of every ``n`` successive elements of the array ``values``."""
    return F.expr(
        f"transform(slice({values}, 1, greatest(0, size({values}) - {n - 1})), (x, i) -> xxhash64("
        + ", ".join(["x", *(f"{values}[i + {k}]" for k in range(1, n))])
        + "))"
    )


def _hashed(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.transform(words_of(F.col("text")), lambda word: F.xxhash64(word)).alias("hashes"))


def _spelled(words: str, n: str) -> Column:
    """Every ``n`` successive words, joined by blanks."""
    return F.expr(
        f"transform(sequence(1, greatest(1, size({words}) - {n} + 1)), i -> array_join(slice({words}, i, {n}), ' '))"
    )


def fingerprint(shingles: str) -> Column:
    """SimHash of an array of strings; each counts as often as it occurs.

    Two counters of 31 bits are added up at a time, which no array can fill.
    """
    sums = [
        f"aggregate(hashes, 0L, (sum, h) -> sum + (shiftrightunsigned(h, {b}) & {1 | 1 << 31}L))" for b in range(31)
    ] + [
        f"aggregate(hashes, 0L, (sum, h) -> sum + (shiftrightunsigned(h, {b}) & 1L))" for b in (62, 63)
    ]
    bits = [
        f"if(2 * (shiftrightunsigned(sums[{b}], {31 * k}) & {(1 << 31) - 1}L) > size(hashes), shiftleft(1L, {b + 31 * k}), 0L)"
        for b in range(31)
        for k in range(2)
    ] + [f"if(2 * sums[{31 + k}] > size(hashes), shiftleft(1L, {62 + k}), 0L)" for k in range(2)]
    # a one-element array names what would else be worked out for every bit
    counted = f"transform(array({shingles}), given -> transform(given, s -> xxhash64(s)))"
    counted = f"transform({counted}, hashes -> named_struct('hashes', hashes, 'sums', array({', '.join(sums)})))"
    folded = " | ".join(bits).replace("sums[", "x.sums[").replace("size(hashes)", "size(x.hashes)")
    return F.expr(f"transform({counted}, x -> {folded})[0]")


def _blocks(fingerprint: str) -> Column:
    """``RADIUS + 1`` pieces of a fingerprint: within the radius at least one is equal."""
    n = RADIUS + 1
    edges = [64 * k // n for k in range(n + 1)]
    pieces = [
        f"struct({k}, shiftrightunsigned({fingerprint}, {a}) & {(1 << (b - a)) - 1}L)"
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    return F.expr(f"array({', '.join(pieces)})")


def similarity(x: str, y: str) -> Column:
    """Sum of the smaller over the sum of the larger weights of two arrays of shingles."""
    plain = f"size(array_intersect({x}, {y}))"
    counted = (
        f"aggregate(array_distinct({x}), 0, (sum, s) -> sum + least(size(filter({x}, t -> t = s)), size(filter({y}, t -> t = s))))"
    )
    once = f"size(array_distinct({x})) = size({x}) and size(array_distinct({y})) = size({y})"
    both = f"(if({once}, {plain}, {counted}))"
    return F.expr(f"100.0D * {both} / (size({x}) + size({y}) - {both})")


def _starts() -> Column:
    """Starts of all windows that hold enough of the shared places ``at`` (sorted), each once.

    A window of ``length`` (or of all ``n`` words) has ``own`` shingles, and needs
    ``need`` of them. It holds the ``need`` places from some one on, and is listed
    with the first of these that it holds.
    """
    own = "(least(length, n) - width + 1)"
    need = f"cast(ceil({SIMILAR} * ({own} + length - width + 1) / {100 + SIMILAR}D) as int)"
    first = f"greatest(0, at[i + {need} - 1] - {own} + 1, if(i > 0, at[i - 1] + 1, 0))"
    last = "least(p, greatest(0, n - length))"
    ranges = f"transform(slice(at, 1, greatest(0, size(at) - {need} + 1)), (p, i) -> if({first} <= {last}, sequence({first}, {last}), array()))"
    return F.expr(f"flatten({ranges})")


def _items(benchmark: DataFrame) -> DataFrame:
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    sized = words.select("*", F.size("words").alias("length"), F.least(F.size("words"), F.lit(SHINGLE)).alias("width"))
    return sized.select("*", _spelled("words", "width").alias("shingles"), F.monotonically_increasing_id().alias("item"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Windows of documents that hold a benchmark item: ``doc_id``, ``key``, ``item_id``, ``start``, ``similarity``.

    A window has as many words as the item (or is the whole document, if that is
    shorter), lower-cased. It matches if the five-word shingles of both, weighted
    by how often they occur, share ``SIMILAR`` percent. Items of fewer words are
    one shingle of their own length.

    An equi-join finds where the shingles of documents are those of items of some
    length. A matching window holds so many of these places that ``SIMILAR`` percent
    can be reached, in whatever order; every window of the length that does gets a
    SimHash. Windows and items of one length meet where one of ``RADIUS + 1`` blocks
    of their fingerprints agrees, which holds for all within the radius; what is
    left is confirmed on the shingles themselves.

    Null and empty texts and items match nothing; null ids are carried along;
    repeated rows are found each; empty tables give an empty one.
    """
    items, n_items = cut_counted(_items(benchmark), "items")
    widths = sorted(row[0] for row in items.select("width").distinct().collect())  # five at most
    docs = keyed(docs)
    hits = []
    for width in widths:
        own = items.where(F.col("width") == width).select("length", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
        seeds = own.select("length", F.explode(_runs("h", width)).alias("shingle")).distinct()
        seeds, n = cut_counted(seeds, "item-shingles")
        runs = _hashed(docs, "doc_id", "key").select(
            "doc_id", "key", F.size("hashes").alias("n"), F.posexplode(_runs("hashes", width)).alias("pos", "shingle")
        )
        found = runs.join(F.broadcast(seeds) if n <= BROADCAST_ROWS else seeds, "shingle")
        hits.append(found.select("doc_id", "key", F.lit(width).alias("width"), "length", "n", "pos"))
    if not hits:
        return docs.select("doc_id", "key", F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("start"), F.lit(0.0).alias("similarity")).limit(0)
    # at most as many windows of a length as the document has words
    at = reduce(DataFrame.unionAll, hits).groupBy("doc_id", "key", "width", "length", "n").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    starts = at.withColumn("starts", _starts()).where("size(starts) > 0").select("doc_id", "key", F.struct("width", "length", "starts").alias("place"))
    places, n = cut_counted(starts.groupBy("doc_id", "key").agg(F.collect_list("place").alias("places")), "windows")
    texts = only_rows_of(docs, places.select("key"), ["key"], n).dropDuplicates(["doc_id", "key"])
    places = F.broadcast(places) if n <= BROADCAST_ROWS // 10 else places
    placed = texts.alias("t").join(places.alias("p"), F.expr("t.key = p.key and t.doc_id <=> p.doc_id"))
    windows = placed.select("t.doc_id", "t.key", words_of(F.col("text")).alias("all"), "places")
    windows = windows.select("doc_id", "key", "all", F.explode("places").alias("place"))
    windows = windows.select("doc_id", "key", "all", "place.width", "place.length", F.explode("place.starts").alias("start"))
    windows = windows.select("doc_id", "key", "length", "width", "start", F.expr("slice(all, start + 1, length)").alias("words"))
    windows = windows.select("doc_id", "key", "length", "width", "start", _spelled("words", "width").alias("shingles"))
    windows = cut(
        windows.withColumn("print", fingerprint("shingles")).withColumn("window", F.monotonically_increasing_id()), "windows"
    )
    prints = cut(items.withColumn("item_print", fingerprint("shingles")), "item-prints")
    by = ["length", "block"]
    mine = windows.select("window", "print", "length", F.explode(_blocks("print")).alias("block"))
    theirs = prints.select("item", "item_print", "length", F.explode(_blocks("item_print")).alias("block"))
    near = mine.join(theirs, by).where(f"bit_count(print ^ item_print) <= {RADIUS}").select("window", "item").distinct()
    return (
        near.join(windows, "window")
        .join(prints.select("item", "item_id", F.col("shingles").alias("item_shingles")), "item")
        .withColumn("similarity", similarity("shingles", "item_shingles"))
        .where(f"similarity >= {SIMILAR}")
        .select("doc_id", "key", "item_id", "start", "similarity")
    )


def judge_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document's ``doc_id``, ``key``, ``n_windows``, ``items`` (sorted ids) and ``kept`` (false if it holds an item)."""
    found = contaminated(docs, benchmark).groupBy("doc_id", "key").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_set("item_id")).alias("found")
    )
    found, n = cut_counted(found, "contaminated")
    found = F.broadcast(found) if n <= BROADCAST_ROWS // 10 else found
    rows = keyed(docs).select("doc_id", "key")
    both = rows.alias("d").join(found.alias("f"), F.expr("d.key = f.key and d.doc_id <=> f.doc_id"), "left")
    return both.select(
        "d.doc_id",
        "d.key",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_windows"),
        F.coalesce("found", F.array().cast("array<long>")).alias("items"),
        F.isnull("n").alias("kept"),
    )
