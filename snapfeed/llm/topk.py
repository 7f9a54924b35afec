"""Exact search for the largest inner products: KD-trees per shard, read best box first."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Vectors that a query is given, and the divisor of the ids that ask.
TOP, ASKING = 20, 20
#: Components become whole multiples of one in so many.
SCALE = 64
#: Bytes of the vectors of a shard, vectors of a leaf, queries that meet a shard in one task.
SHARD_BYTES, LEAF, ASKED = 4 << 20, 256, 1024
#: Sampled vectors, and bytes of them, that the borders between shards are drawn from.
SAMPLE, SAMPLE_BYTES = 1 << 14, 16 << 20
#: Lengths of vectors that have borders; vectors of rarer lengths are dealt out by hash alone.
SPACES = 16

#: Beyond it a product may need more than the 53 bits of a double.
_EXACT = 1 << 53


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``v``: vectors of whole numbers; those with a component that is no finite number are left out."""
    value = F.col("embedding")

    def fine(x: Column) -> Column:
        wide = x.cast("double")
        return wide.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < F.lit(float("inf")))

    usable = embeddings.where(value.isNotNull() & F.forall(value, fine))
    whole = F.transform(value, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """Vectors of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), length)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products, exactly: in doubles where these suffice, else in whole numbers of any size."""
    top = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (queries, vectors)]
    if top[0] * top[1] * max(1, queries.shape[1]) < _EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    exact = np.dot(queries.astype(object), vectors.astype(object).T)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest product that each query can have within each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    top = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (queries, low, high)]
    if top[0] * max(top[1:]) * max(1, queries.shape[1]) < _EXACT:
        return products(up, high) + products(down, low)
    exact = np.dot(up.astype(object), high.astype(object).T) + np.dot(down.astype(object), low.astype(object).T)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Tree:
    """A KD-tree in arrays: the children of each node (none: a leaf), its box and its rows in ``order``."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        self.low, self.high, self.rows, self.child = [], [], [], []
        self.axis, self.border = [], []
        self._grow(vectors, leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.child = np.array(self.child)

    def _grow(self, vectors: np.ndarray, leaf: int) -> None:
        open_ = [(0, len(vectors), -1, 0)]
        while open_:
            a, b, parent, side = open_.pop()
            node = len(self.rows)
            if parent >= 0:
                self.child[parent][side] = node
            own = self.order[a:b]
            low, high = vectors[own].min(axis=0), vectors[own].max(axis=0)
            for held, value in ((self.low, low), (self.high, high), (self.rows, (a, b)), (self.child, [-1, -1])):
                held.append(value)
            spread = high.astype(np.float64) - low
            axis = int(spread.argmax()) if len(spread) else 0
            if b - a <= leaf or not len(spread) or not spread[axis]:
                self.axis.append(-1)
                self.border.append(0)
                continue
            values = vectors[own, axis]
            middle = (b - a) // 2
            turned = own[np.argpartition(values, middle)]
            border = int(vectors[turned[middle], axis])
            right = vectors[turned, axis] >= border
            if right.all():  # the median is the least value: it goes left
                border = int(values[values > border].min())
                right = vectors[turned, axis] >= border
            self.order[a:b] = np.concatenate([turned[~right], turned[right]])
            cut_at = a + int((~right).sum())
            self.axis.append(axis)
            self.border.append(border)
            open_ += [(cut_at, b, node, 1), (a, cut_at, node, 0)]

    def cell(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into."""
        node = np.zeros(len(vectors), np.int64)
        axis, border = np.array(self.axis), np.array(self.border)
        while True:
            inner = np.flatnonzero(axis[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            side = vectors[inner, axis[at]] >= border[at]
            node[inner] = self.child[at, side.astype(int)]


Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def best_of(found: list[Found], n: int) -> Found:
    """The ``n`` best of (query, score, row) per query: highest score, then first row."""
    query, score, row = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((row, ~score, query))  # ~ falls as score rises, at both ends of 64 bits too
    query, score, row = query[order], score[order], row[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < n], score[place < n], row[place < n]


def search(
    tree: Tree, vectors: np.ndarray, weights: np.ndarray, queries: np.ndarray, least: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors that may be among the ``top`` of each query (its number, the score, the row), and each query's limit.

    Every query has an open list of nodes. In each round it takes the open node of
    the largest bound; an inner one opens its children, a leaf is scored, together
    with the other queries that have come to it. A query ends when no open bound
    reaches its limit: the score that ``top`` ids have reached (``weights`` tells
    how many ids a vector has), or ``least`` from elsewhere. Vectors that equal
    the limit are kept, as their ids decide.
    """
    n, limit = len(queries), least.copy()
    never = np.iinfo(np.int64).min
    reach = np.maximum(bounds(queries, tree.low, tree.high), never + 1)
    waiting = np.zeros(reach.shape, bool)
    waiting[:, 0] = True
    everyone = np.arange(n)
    kept: Found = (np.zeros(0, np.int64),) * 3
    while True:
        open_ = np.where(waiting, reach, never)
        node = open_.argmax(axis=1)
        going = waiting[everyone, node] & (open_[everyone, node] >= limit)
        if not going.any():
            return *kept, limit
        who, node = everyone[going], node[going]
        waiting[who, node] = False
        inner = tree.child[node, 0] >= 0
        for side in (0, 1):
            waiting[who[inner], tree.child[node[inner], side]] = True
        who, node = who[~inner], node[~inner]
        if not len(who):
            continue
        found = [kept]
        order = np.argsort(node, kind="stable")
        who, node = who[order], node[order]
        edges = np.flatnonzero(np.diff(node, prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(node)), strict=True):
            first, last = tree.rows[node[a]]
            rows = tree.order[first:last]
            score = products(queries[who[a:b]], vectors[rows])
            line = limit[who[a:b]]
            if len(rows) > top:  # what at least `top` others here exceed is out
                line = np.maximum(line, np.partition(score, len(rows) - top, axis=1)[:, len(rows) - top])
            i, j = np.nonzero(score >= line[:, None])
            found.append((who[a:b][i], score[i, j], rows[j]))
        kept = best_of(found, top)
        query, score, row = kept
        # the limit is the score at which the ids reached so far are enough
        total = np.cumsum(weights[row])
        start = np.searchsorted(query, query)
        ids = total - np.where(start > 0, total[start - 1], 0)
        enough = np.flatnonzero(ids >= top)
        if len(enough):
            first = enough[np.unique(query[enough], return_index=True)[1]]
            limit[query[first]] = np.maximum(limit[query[first]], score[first])


def distinct_vectors(rows: DataFrame, top: int) -> DataFrame:
    """``id``, ``size``, ``v`` and the first ``top + 1`` ids of the rows that hold ``v``, stored.

    Rows of one vector have one score, so that no more of them can be among a
    query's best and its own row. What goes beyond is dropped before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last()))
    few = rows.withColumn("place", place).where(F.col("place") <= top + 1)
    ids = F.sort_array(F.collect_list(F.struct("place", "vec_id")))
    held = few.groupBy("v").agg(F.transform(ids, lambda x: x["vec_id"]).alias("ids"))
    named = held.withColumn("id", F.monotonically_increasing_id()).withColumn("size", F.size("v"))
    return cut(named.select("id", "size", "v", "ids"), "topk-vectors")


def border_trees(vectors: DataFrame, shard_bytes: int) -> dict[int, Tree]:
    """A tree for each frequent length of vectors, whose leaves are cells of about a shard.

    Only the borders come from a sample of bounded size, drawn by a hash of the
    id; every vector is put into a cell, and a cell's box is that of all its vectors.
    """
    sizes = vectors.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "size").limit(SPACES).collect()
    large = {row["size"]: row["n"] for row in sizes if row["n"] * row["size"] * 8 > shard_bytes}
    trees = {}
    for size, n in large.items():
        share = min(1.0, SAMPLE / n, SAMPLE_BYTES / (8 * size * n))
        drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < math.ceil(share * (1 << 30))
        sample = vectors.where((F.col("size") == size) & drawn).select("v").toArrow()
        if sample.num_rows:
            leaf = max(8, math.ceil(sample.num_rows * shard_bytes / (8 * size * n)))
            trees[size] = Tree(matrix(whole(sample["v"]), size), leaf)
    return trees


_SHARD = pa.schema(
    [("shard", pa.int64()), ("size", pa.int32()), ("cell", pa.int64()), ("first", pa.bool_())]
    + [(x, pa.binary()) for x in ("low", "high", "vectors")]
    + [("vid", pa.list_(pa.int64())), ("ids", pa.list_(pa.list_(pa.int64())))]
)


def shards(vectors: DataFrame, trees: dict[int, Tree], shard_bytes: int) -> DataFrame:
    """One row per shard, stored: a part of a cell with its box and its vectors, by their first id."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            cell = np.zeros(len(sizes), np.int64)
            for size in set(sizes.tolist()) & trees.keys():
                mine = np.flatnonzero(sizes == size)
                cell[mine] = trees[size].cell(matrix(batch.column("v").take(pa.array(mine)), size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    schema = "id long, size int, v array<long>, ids array<long>, cell long"
    placed = cut(vectors.mapInArrow(cells, schema), "topk-cells")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("size") * 8 / shard_bytes)).cast("int")
    counted = placed.groupBy("size", "cell").agg(F.count("*").alias("n")).select("size", "cell", parts.alias("parts"))
    dealt = placed.join(counted, ["size", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        size, cell, part = (group[x][0].as_py() for x in ("size", "cell", "part"))
        ids = whole(group["ids"])
        first = [x[0] for x in ids.to_pylist()]
        order = pa.array(sorted(range(len(first)), key=lambda i: (first[i] is None, first[i] or 0)))
        values = matrix(whole(group["v"]).take(order), size)
        one = np.array([0, len(first)], np.int32)
        box = [values.min(axis=0).tobytes(), values.max(axis=0).tobytes()]
        return pa.Table.from_arrays(
            [pa.array([0], pa.int64()), pa.array([size], pa.int32()), pa.array([cell], pa.int64()), pa.array([part == 0])]
            + [pa.array([x], pa.binary()) for x in (*box, values.tobytes())]
            + [pa.ListArray.from_arrays(one, whole(group["id"]).take(order)), pa.ListArray.from_arrays(one, ids.take(order))],
            schema=_SHARD,
        )

    schema = "shard long, size int, cell long, first boolean, low binary, high binary, vectors binary, vid array<long>, ids array<array<long>>"
    built = dealt.groupBy("size", "cell", "part").applyInArrow(build, schema)
    return cut(built.withColumn("shard", F.monotonically_increasing_id()), "topk-shards")


_ROUTED = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("cell", pa.int64()), ("least", pa.int64()), ("best", pa.bool_())])


def routes(asks: DataFrame, boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """``id``, ``size``, ``cell``, ``least`` and ``best``: the cells in which a query (``id``, ``size``, ``v``, ``least``) may reach its limit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            ids, least = batch.column("id").to_numpy(), batch.column("least").to_numpy()
            for size in set(sizes.tolist()):
                for mine in np.array_split(mine := np.flatnonzero(sizes == size), -(-len(mine) // ASKED)):
                    if size in boxes:
                        cell, low, high = boxes[size]
                        reach = bounds(matrix(batch.column("v").take(pa.array(mine)), size), low, high)
                        i, j = np.nonzero(reach >= least[mine][:, None])
                        best = reach.argmax(axis=1)[i] == j
                    else:
                        cell, i, j = np.zeros(1, np.int64), np.arange(len(mine)), np.zeros(len(mine), int)
                        best = np.ones(len(mine), bool)
                    columns = [pa.array(ids[mine][i]), pa.array(sizes[mine][i]), pa.array(cell[j]), pa.array(least[mine][i]), pa.array(best)]
                    yield pa.RecordBatch.from_arrays(columns, schema=_ROUTED)

    return asks.mapInArrow(work, "id long, size int, cell long, least long, best boolean")


_FOUND = pa.schema([("id", pa.int64()), ("score", pa.int64()), ("own", pa.bool_()), ("line", pa.int64()), ("ids", pa.list_(pa.int64()))])
_NEVER = -(1 << 63)


def visited(asks: DataFrame, stored: DataFrame, top: int, blocks: int, leaf: int) -> DataFrame:
    """What queries (``shard``, ``id``, ``v``, ``least``) find in the shards that they visit.

    A shard meets its queries in blocks of bounded size; it is sent as often as
    there are blocks of queries that ask for it.
    """
    dealt = cut(asks.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), "topk-asks")
    wanted = dealt.select("shard", F.col("block").alias("of")).distinct()
    copies = stored.withColumnRenamed("shard", "to").join(wanted, F.col("to") == F.col("shard"))
    copies = copies.select("to", "of", "size", "vectors", "vid", "ids")

    def work(asked: pa.Table, shard: pa.Table) -> pa.Table:
        size = shard["size"][0].as_py()
        vid, ids = whole(shard["vid"]).flatten().to_numpy(), whole(shard["ids"]).flatten()
        vectors = np.frombuffer(shard["vectors"][0].as_py(), np.int64).reshape(len(vid), size)
        queries, own = matrix(whole(asked["v"]), size), asked["id"].to_numpy()
        least = asked["least"].to_numpy()
        weights = np.diff(ids.offsets.to_numpy())
        query, score, row, limit = search(Tree(vectors, leaf), vectors, weights, queries, least, top)
        columns = [own[query], score, own[query] == vid[row], limit[query]]
        return pa.Table.from_arrays([*map(pa.array, columns), ids.take(pa.array(row))], schema=_FOUND)

    schema = "id long, score long, own boolean, line long, ids array<long>"
    asked = dealt.select("shard", "block", "id", "v", "least").groupBy("shard", "block")
    return asked.cogroup(copies.groupBy("to", "of")).applyInArrow(work, schema)


def top_products(
    embeddings: DataFrame,
    top: int = TOP,
    asking: int = ASKING,
    shard_bytes: int = SHARD_BYTES,
    leaf: int = LEAF,
    asked: int = ASKED,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``top`` largest inner products of each query.

    Queries are the rows whose id ``asking`` divides; candidates are all rows but
    the query's own. Equal vectors are one, with their first ids, and are asked
    for once. The vectors are put into cells by a tree of medians, and a cell into
    shards of bounded size. A query first visits the shard whose box promises
    most; the score that it has reached there is its limit for all others, of
    which it visits those whose box can reach it. Within a shard a KD-tree of
    median splits and tight boxes is read best box first (:func:`search`).

    Components are taken as ``floor(64 * x)``, held to 64 bits, as are scores; the
    products are exact. Null vectors and such with a null or non-finite component
    take no part. Vectors are compared with those of their own length; empty ones
    have product 0. Equal scores go by ascending id, null last. A row without an id
    does not ask; repeated rows ask and are found one by one, so that a row's
    equal is among its candidates. An empty table gives an empty result. Other
    columns are left out.
    """
    rows = whole_vectors(embeddings)
    vectors = distinct_vectors(rows, top)
    asking_rows = rows.where(F.col("vec_id") % asking == 0).groupBy("v", "vec_id").agg(F.count("*").alias("copies"))
    asking_rows = cut(asking_rows.join(vectors.select("v", "id"), "v").select("id", F.col("vec_id").alias("query_id"), "copies"), "topk-asking")
    queries = cut(vectors.join(asking_rows.select("id").distinct(), "id", "left_semi").select("id", "size", "v"), "topk-queries")
    blocks = max(1, math.ceil(queries.count() / asked))
    trees = border_trees(vectors, shard_bytes)
    stored = shards(vectors, trees, shard_bytes)
    boxes = _boxes(stored, trees)
    places = stored.select("shard", "size", "cell", "first")

    asks = queries.withColumn("least", F.lit(_NEVER))
    first = routes(asks, boxes).where("best").join(places.where("first").drop("first"), ["size", "cell"])
    met = first.join(queries.select("id", "v"), "id").select("shard", "id", "v", "least")
    found = cut(visited(met, stored, top + 1, blocks, leaf), "topk-first")
    lines = found.groupBy("id").agg(F.max("line").alias("line"))
    asks = queries.join(lines, "id", "left").withColumn("least", F.coalesce("line", F.lit(_NEVER))).drop("line")
    rest = routes(asks, boxes).join(places, ["size", "cell"]).where("not (best and first)")
    met = rest.join(queries.select("id", "v"), "id").select("shard", "id", "v", "least")
    found = found.unionAll(visited(met, stored, top + 1, blocks, leaf))

    each = found.select("id", "score", "own", F.explode("ids").alias("vec_id"))
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("own").desc()]
    place = F.row_number().over(Window.partitionBy("id").orderBy(*order))
    few = each.withColumn("place", place).where(F.col("place") <= top + 1)
    listed = few.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("best"))
    both = asking_rows.join(listed, "id")
    # the query's own row is one of its equals
    mine = F.array_position(F.transform("best", lambda x: x["own"] & x["vec_id"].eqNullSafe(F.col("query_id"))), True)
    others = F.slice(F.filter(F.col("best"), lambda x: x["place"] != F.col("mine")), 1, top)
    both = both.withColumn("mine", mine).withColumn("others", others)
    both = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    ranked = both.select("query_id", F.posexplode("others").alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _boxes(stored: DataFrame, trees: dict[int, Tree]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cells and their boxes, of the lengths that have borders: as many as the trees have leaves at most."""

    def work(group: pa.Table) -> pa.Table:
        size = group["size"][0].as_py()
        low, high = (np.frombuffer(b"".join(group[x].to_pylist()), np.int64).reshape(-1, size) for x in ("low", "high"))
        columns = [group["size"][:1], group["cell"][:1], pa.array([low.min(axis=0).tobytes()]), pa.array([high.max(axis=0).tobytes()])]
        return pa.Table.from_arrays([whole(pa.chunked_array(x)) if isinstance(x, pa.ChunkedArray) else x for x in columns], names=["size", "cell", "low", "high"])

    mine = stored.where(F.col("size").isin(list(trees))).select("size", "cell", "low", "high")
    rows = mine.groupBy("size", "cell").applyInArrow(work, "size int, cell long, low binary, high binary").collect() if trees else []
    out = {}
    for size in trees:
        own = sorted((row for row in rows if row["size"] == size), key=lambda row: row["cell"])
        if own:
            boxes = [np.frombuffer(b"".join(row[x] for row in own), np.int64).reshape(len(own), size) for x in ("low", "high")]
            out[size] = (np.array([row["cell"] for row in own], np.int64), *boxes)
    return out
