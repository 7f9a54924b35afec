"""Ranked search, spelling variants and largest products against plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from snapfeed.llm import search, spelling, topk
from snapfeed.llm.search import rank_documents
from snapfeed.llm.spelling import group_spellings
from snapfeed.llm.topk import top_products

DOCS = "doc_id long, text string, lang string, score long, item string"


def terms_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(search.TERM, lower)


def ranked(docs, items, top):
    """Rows (item_id, rank, doc_id, score) by definition."""
    found = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    found = [(doc_id, tf) for doc_id, tf in found if tf]
    n_docs, all_terms = len(found), sum(tf.total() for _, tf in found)
    df = Counter(term for _, tf in found for term in tf)
    rows = []
    for item_id, text in set(items):
        if text is None:
            continue
        scored = []
        for doc_id, tf in found:
            m = 50 + (50 * tf.total() * n_docs) // all_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 20 * m))
                for x in set(terms_of(text)) & tf.keys()
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        best = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top]
        rows += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(best, 1)]
    return sorted(rows, key=repr)


def test_ranked(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["Ünder", "naïve", "日本", "A1", "x_y", "é-è"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 60)))) for i in range(300)]
    docs += [(7, "w1 W2 w3"), (7, "w1 W2 w3"), (None, "w1 w2 w3"), (400, None), (401, ""), (402, "--- ..."), (403, "w1 w2 w3")]
    docs += [(404, "w5 " * 5000), (405, "q" * 3_000_000 + " w5")]
    items = [(1, "w1 w2 W2 w3"), (2, "naïve 日本 ünder Ünder"), (3, "nowhere"), (4, None), (None, "w9"), (5, "w1"), (5, "w2")]
    items += [(5, "w2"), (6, " ".join(words)), (8, "q" * 3_000_000)]
    given = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS).repartition(5)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    for top in (50, 3):
        result = rank_documents(given, asked, top)
        assert result.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, result.collect()), key=repr) == ranked(docs, items, top)


def test_ranked_items_in_groups(spark, monkeypatch):
    monkeypatch.setattr(search, "ITEM_BYTES", 20)
    docs = [(i, f"a{i % 3} b{i % 5} c") for i in range(40)]
    items = [(i, f"a{i % 3} b{i}") for i in range(7)]
    result = rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted(map(tuple, result.collect()), key=repr) == ranked(docs, items, 4)


def test_ranked_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rank_documents(docs.limit(0), items).collect() == []
    assert rank_documents(docs, items.limit(0)).collect() == []


def test_windows_cut_no_term(monkeypatch):
    monkeypatch.setattr(search, "WINDOW", 7)
    text = "ab  cdefghijklmnopqrstuvwxyz É1 " * 5
    assert [x.decode() for words in search.term_windows(text.encode()) for x in words] == terms_of(text)


def test_lists_are_read_until_resolved(monkeypatch):
    monkeypatch.setattr(search, "FIRST", 2)
    draw = np.random.default_rng(3)
    for _ in range(200):
        n, top, least = int(draw.integers(1, 60)), int(draw.integers(1, 6)), int(draw.integers(0, 12))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(draw.integers(1, 5))):
            docs = draw.permutation(n)[: draw.integers(1, n + 1)]
            impacts = np.sort(draw.integers(1, 9, len(docs)))[::-1]
            lists.append((docs, impacts))
            total[docs] += impacts
        rows, scores = search.read_lists(lists, n, top, least)
        assert (scores == total[rows]).all()
        limit = max(least, 1, sorted(total)[-top] if n >= top else 0)
        assert set(np.flatnonzero(total >= limit)) <= set(rows)


def test_high_impacts_end_the_reading_early():
    """With a limit from elsewhere, the tails of the lists are never read."""

    class Read(np.ndarray):
        pass

    docs = np.arange(100_000)
    impacts = np.arange(100_000, 0, -1)
    seen = []
    own = docs.view(Read)
    monkey = lambda self, key: (seen.append(key), np.ndarray.__getitem__(self, key))[1]
    Read.__getitem__ = monkey
    search.read_lists([(own, impacts)], 100_000, 5, 99_990)
    assert max(key.stop for key in seen if isinstance(key, slice)) <= search.FIRST * 5


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spellings(docs):
    total = Counter()
    for doc_id, text in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    words = {word: n for word, n in total.items() if len(word) >= 5 and n >= 3}
    rows, form = {}, {}
    for word, n in words.items():
        others = [x for x in words if near(word, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[word] = best if best and words[best] >= 2 * n else None
        rows[word] = (n, len(others), form[word], words.get(form[word]))
    out = []
    for word, row in rows.items():
        root = word
        while form[root]:
            root = form[root]
        out.append((word, *row, root))
    return sorted(out, key=repr)


def test_spellings(spark):
    draw = random.Random(8)
    bases = ["house", "garten", "école", "naïveté", "aaaaaaa", "abababab", "straße", "señorita", "ÀÉÎÕÜ"]
    letters = "abehnorstéü×÷"

    def variant(word):
        for _ in range(draw.randint(0, 2)):
            k = draw.randrange(len(word))
            word = draw.choice([word[:k] + word[k + 1 :], word[:k] + draw.choice(letters) + word[k:], word[:k] + draw.choice(letters) + word[k + 1 :]])
        return word

    docs = [(i, " ".join(variant(draw.choice(bases)) for _ in range(60))) for i in range(120)]
    long = "ab" * 4000
    docs += [(None, "house House HOUSE"), (None, None), (500, ""), (501, "12 34"), (502, f"{long} {long} {long} {long} {long}")]
    docs += [(503, f"{long}c-{long}c_{long}c"), (504, "garten " * 50), (504, "garten " * 50)]
    given = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string").repartition(4)
    result = group_spellings(given).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(map(tuple, result.collect()), key=repr) == spellings(docs)


def test_spellings_of_nothing(spark):
    assert group_spellings(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert group_spellings(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == []


def test_forms_lead_to_the_end(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(25)]
    found = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert sorted(map(tuple, found)) == [(word, "w25") for word, _ in chain]


def test_neighbourhoods_are_whole(monkeypatch):
    monkeypatch.setattr(spelling, "CELLS", 30)
    draw = np.random.default_rng(2)
    for _ in range(60):
        r, n = int(draw.integers(2, 6)), int(draw.integers(1, 9))
        words = draw.integers(0, r, (int(draw.integers(1, 5)), n))
        found = [np.concatenate(x) for x in zip(*spelling.neighbour_keys(words, r), strict=True)]
        for row, word in enumerate(words):
            edits = {tuple(word)}
            for i in range(n + 1):
                edits |= {(*word[:i], c, *word[i:]) for c in range(r)}
                if i < n:
                    edits |= {(*word[:i], *word[i + 1 :])} | {(*word[:i], c, *word[i + 1 :]) for c in range(r)}
            keys = found[1][found[0] == row].tolist()
            assert len(keys) == len(set(keys)) == len(edits)
            assert set(keys) == {int(spelling.own_key(np.array([x], np.int64))[0]) for x in edits}


def test_filters_hold_their_keys(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) as key")
    known = spelling.filter_of(keys, 3000)
    assert known.may_hold(np.array([row.key for row in keys.collect()])).all()
    others = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    assert known.may_hold(others).mean() < 0.01
    assert spelling.filter_of(keys, spelling.FILTER_BYTES) is None


def nearest(rows, top, asking):
    whole = []
    for vec_id, vector in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            held = [64 * float(np.float32(x)) for x in vector]
            whole.append((vec_id, [max(-(1 << 63), min((1 << 63) - 1, math.floor(x))) for x in held]))
    out = []
    for i, (q, x) in enumerate(whole):
        if q is None or q % asking:
            continue
        scored = []
        for j, (c, y) in enumerate(whole):
            if i != j and len(x) == len(y):
                score = sum(a * b for a, b in zip(x, y, strict=True))
                scored.append((-max(-(1 << 63), min((1 << 63) - 1, score)), c is None, c))
        best = sorted(scored, key=lambda z: (z[0], z[1], z[2] or 0))[:top]
        out += [(q, rank, c, -score) for rank, (score, _, c) in enumerate(best, 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def vectors():
    draw = random.Random(4)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, draw.random()]) for _ in range(6)]) for i in range(500)]
    rows += [(600 + i, [0.5] * 6) for i in range(150)]
    rows += [(20, [0.5] * 6), (20, [0.5] * 6), (None, [0.5] * 6), (None, [1.0] * 6), (40, None), (60, [None, 1.0, 1.0]), (80, [float("nan")])]
    rows += [(100, [float("inf")] * 6), (120, []), (140, []), (160, [1.0, 2.0]), (180, [2.0, -1.0]), (200, [3.0])]
    rows += [(220, [1e30, -1e30, 1.0]), (240, [1e30, 1e30, 2.0]), (260, [1e10, 1e12, 2.0]), (280, [1e12, 1e11, -3.0])]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 1 << 10, "leaf": 4, "asked": 7}, {"shard_bytes": 1 << 12, "leaf": 1, "asked": 1000}])
def test_products(spark, vectors, sizes):
    schema = "vec_id long, embedding array<float>, rank int, id string, size int"
    given = spark.createDataFrame([(*row, 1, "x", 2) for row in vectors], schema).repartition(6)
    result = top_products(given, 5, **sizes)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, result.collect()), key=repr) == nearest(vectors, 5, 20)


def test_products_of_nothing(spark):
    assert top_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert top_products(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")).collect() == []


def test_boxes_spare_leaves():
    """Where vectors lie in clusters, most leaves are never scored."""
    draw = np.random.default_rng(1)
    centres = draw.integers(-500, 500, (40, 16))
    vectors = (centres[draw.integers(0, 40, 8000)] + draw.integers(-9, 9, (8000, 16))).astype(np.int64)
    tree = topk.Tree(vectors, 64)
    scored = []
    plain = topk.products
    try:
        topk.products = lambda q, v: (scored.append(len(v)) if len(q) == 1 and len(v) <= 64 else None, plain(q, v))[1]
        for k in range(20):
            scored.clear()
            _, score, _, limit = topk.search(tree, vectors, np.ones(8000, np.int64), vectors[k : k + 1], np.array([-(1 << 63)]), 10)
            assert sorted(score)[-10:] == sorted((vectors @ vectors[k]).tolist())[-10:]
            assert sum(scored) < 4000
    finally:
        topk.products = plain


def test_trees_hold_all_rows_in_tight_boxes():
    draw = np.random.default_rng(6)
    for n, spread in ((1, 3), (500, 2), (500, 1000), (64, 1)):
        vectors = draw.integers(0, spread, (n, 4))
        tree = topk.Tree(vectors, 8)
        leaves = [i for i in range(len(tree.rows)) if tree.child[i, 0] < 0]
        assert sorted(r for i in leaves for r in tree.order[slice(*tree.rows[i])]) == list(range(n))
        for i in range(len(tree.rows)):
            own = vectors[tree.order[slice(*tree.rows[i])]]
            assert (own.min(axis=0) == tree.low[i]).all() and (own.max(axis=0) == tree.high[i]).all()
            assert tree.child[i, 0] >= 0 or len(own) <= 8 or (own == own[0]).all()
        assert all(vectors[j].tolist() in vectors[tree.order[slice(*tree.rows[c])]].tolist() for j, c in enumerate(tree.cell(vectors)))
