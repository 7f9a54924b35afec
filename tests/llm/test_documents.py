"""Operators on documents against brute force, on a table of hard cases."""

import collections
import hashlib
import random
import re

import pytest

from snapfeed.llm import pii, tokens
from snapfeed.llm.decontam import judge_contamination
from snapfeed.llm.mixing import mix_sources, mixed_documents, source_targets
from snapfeed.llm.neardup import near_duplicates
from snapfeed.llm.quality import judge_quality
from snapfeed.llm.repeats import remove_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, source string, kept string, `comp` int"


def words(draw, n):
    return [draw.choice("ta ba lo mi ko re sa nu ve di".split()) + draw.choice("n r s t l".split()) + str(draw.randrange(4)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    base = [words(draw, 80) for _ in range(6)]
    texts = [" ".join(w) for w in base]
    for k in range(40):  # near copies of all strengths, and shared passages
        w = list(base[k % 6])
        for _ in range(draw.randrange(6)):
            w[draw.randrange(len(w))] = "x" + str(draw.randrange(1000))
        texts.append(" ".join(w[draw.randrange(4) :]))
    passage = " ".join(words(draw, 30))
    texts += [" ".join(words(draw, 40)) + "\n" + passage + "\r\n" + " ".join(words(draw, 9)) for _ in range(8)]
    texts += [texts[0], texts[0], "", None, " \t\n", "a b c", "A  b\tc", "a b", "é à ü", "word " * 300, "n\n" * 120]
    texts += ["Long " + " ".join(words(draw, 20_000)), texts[3].upper()]
    out = [(i, text, draw.choice(["s", "hot", "hot", None, "ß"]), "clash", 1) for i, text in enumerate(texts)]
    return out + [(None, texts[0], "s", None, None), out[5]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rule_counts(text):
    w = WORD.findall(text or "")
    windows = collections.defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    covered = {k for places in windows.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    got = judge_quality(docs, labels).collect()
    assert len(got) == len(rows)
    wanted = collections.Counter((i, *rule_counts(text)) for i, text, *_ in rows)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert collections.Counter(tuple(row[x] for x in names) for row in got) == wanted
    for row in got:
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert not (row.base_failed and row.kept)
    assert judge_quality(empty, labels).count() == 0
    assert judge_quality(docs, labels.limit(0)).where("not kept and not base_failed").count() == 0


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_neardup(docs, rows, empty):
    named = {i: shingles(text) for i, text, *_ in rows if i is not None}
    root = {i: i for i in named}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in named:
        for b in named:
            x, y = named[a], named[b]
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.n_shingles, row.component_id) == (len(named[row.doc_id]), find(row.doc_id))
            assert row.kept == (row.doc_id == row.component_id)
    assert near_duplicates(empty).count() == 0


def test_decontamination(spark, docs, rows, empty):
    draw = random.Random(1)
    source = WORD.findall(rows[0][1])
    edited = [*source[:30], "other", *source[31:70]]
    items = [
        (1, " ".join(source[10:40])), (2, " ".join(words(draw, 30))), (3, None), (4, ""), (5, "é à ü"),
        (None, " ".join(edited)), (7, " ".join(source[5:60])), (7, " ".join(source[5:60])), (8, "n n n n n n n n"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def grams(w, n):
        return collections.Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))

    def holds(text, item):
        w, x = (WORD.findall((t or "").lower()) for t in (text, item))
        n = min(5, len(x))
        if not n or len(w) < n:
            return False
        size = sum(grams(x, n).values())
        for s in range(max(1, len(w) - len(x) + 1)):
            c = grams(w[s : s + len(x)], n)
            both = sum((c & grams(x, n)).values())
            if 100 * both >= 75 * (sum(c.values()) + size - both):
                return True
        return False

    got = judge_contamination(docs, benchmark).collect()
    assert len(got) == len(rows)
    by_key = collections.defaultdict(set)
    for i, text, *_ in rows:
        by_key[i].add(text)
    for row in got:
        (text,) = by_key[row.doc_id]
        if len(text or "") < 10_000:
            wanted = sorted({i for i, item in items if i is not None and holds(text, item)})
            assert row["items"] == wanted
            assert row.kept != (bool(wanted) or holds(text, items[5][1]))
    assert judge_contamination(empty, benchmark).count() == 0
    assert judge_contamination(docs, benchmark.limit(0)).where("not kept").count() == 0


def test_decontamination_in_any_order(spark):
    draw = random.Random(5)
    item = words(draw, 40)
    texts = {}
    for turn in range(41):
        texts[turn] = words(draw, 25) + item[turn:] + item[:turn] + words(draw, 25)
    texts[50] = item[20:] + item[:20]
    texts[51] = words(draw, 9) + item[30:] + item[10:30] + item[:10] + words(draw, 9)
    texts[52] = words(draw, 9) + item[:4] + words(draw, 60) + item[3:36]
    texts[53] = item[:20] * 6
    texts[54] = item[2:38]

    def grams(w):
        return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))

    def windows(w):
        x, n = grams(item), 0
        for s in range(max(1, len(w) - len(item) + 1)):
            c = grams(w[s : s + len(item)])
            n += 100 * (c & x).total() >= 75 * (c | x).total()
        return n

    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(words(draw, 40)))], "item_id long, text string")
    got = {row.doc_id: row.n_windows for row in judge_contamination(docs, benchmark).collect()}
    assert got == {i: windows(w) for i, w in texts.items()}
    assert got[20] > 0 and got[50] > 0


def test_repeats(docs, rows, empty):
    starts = collections.defaultdict(set)
    for i, text, *_ in rows:
        if i is not None:
            raw = (text or "").encode()
            for s in range(len(raw) - 49):
                starts[raw[s : s + 50]].add(i)
    low = {key: min(ids) for key, ids in starts.items()}
    wanted = collections.Counter()
    for i, text, *_ in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 49):
            if i is not None and low[raw[s : s + 50]] < i:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        wanted[i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert collections.Counter(map(tuple, remove_repeats(docs).collect())) == wanted
    assert remove_repeats(empty).count() == 0


def test_mixing(docs, rows, empty):
    got = mix_sources(docs, leaf=8, fan=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, mix_sources(docs, leaf=8, fan=4).collect()))
    assert len(got) == len(rows)
    sizes = collections.Counter()
    taken = collections.Counter()
    for row in got:
        sizes[row.source] += row.size
        taken[row.source] += row.taken
        assert row.taken == row.copies * row.size <= 3 * row.size
    targets = {row.source: row.target for row in got}
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: 1 + i % 3 for i, s in enumerate(order)}
    goal, left = {}, dict(weights)
    while True:  # the excess goes round until none is above
        free = (sum(sizes.values()) - sum(goal.values())) / sum(left.values())
        over = [s for s in left if left[s] * free > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            goal[s] = 3 * sizes[s]
            del left[s]
    goal |= {s: w * free for s, w in left.items()}
    for s in sizes:
        assert targets[s] == pytest.approx(goal[s])
        largest = max(row.size for row in got if row.source == s)
        assert abs(taken[s] - goal[s]) <= 0.5 * largest + 1
    whole = mixed_documents(docs.withColumn("size", docs["doc_id"]))
    assert whole.columns == ["doc_id", "text", "source", "kept", "comp", "size", "source_size", "target", "copies", "taken"]
    assert mix_sources(empty).count() == mixed_documents(empty).count() == source_targets(empty.selectExpr("source", "1L as size")).count() == 0


def test_tokens(docs, rows, empty):
    vocabulary = tokens.ranked_vocabulary()
    find = tokens.regex.compile(vocabulary.pattern).findall

    def count(word):
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            pieces = [(n, vocabulary.costs.get(word[end - n : end])) for n in range(1, min(end, 130) + 1)]
            best.append(min((best[end - n][0] + c, best[end - n][1] + 1) for n, c in pieces if c is not None))
        return best[-1][1]

    text = {i: t for i, t, *_ in rows}
    for row in tokens.count_tokens(docs, vocabulary).collect():
        pretokens = find(text.get(row.doc_id, rows[0][1]) or "")
        assert row.n_pretokens == len(pretokens)
        if len(pretokens) < 1000:
            assert row.n_tokens == sum(count(t.encode()) for t in pretokens)
    long_word = "ab" * 5000
    assert tokens.Counter(vocabulary).counts([long_word.encode()[:4096]]) == [count(long_word.encode()[:4096])]
    assert tokens.count_tokens(empty, vocabulary).count() == 0


def test_tokens_of_long_pretokens(spark):
    vocabulary = tokens.ranked_vocabulary()
    draw = random.Random(3)
    letters = "".join(draw.choice("etaoinshr") for _ in range(10_000))
    long_words = ["ab" * 5000, letters, letters[:4096], letters[:9000] + "ing", "的" * 3000, "a" + "的是不" * 1500]

    def count(word):
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            pieces = [(n, vocabulary.costs.get(word[end - n : end])) for n in range(1, min(end, 130) + 1)]
            best.append(min((best[end - n][0] + c, best[end - n][1] + 1) for n, c in pieces if c is not None))
        return best[-1][1]

    wanted = [count(w.encode()) for w in long_words]
    docs = spark.createDataFrame(list(enumerate(long_words)), "doc_id long, text string")
    got = sorted(tokens.count_tokens(docs, vocabulary).collect())
    assert [row.n_pretokens for row in got] == [1] * len(long_words)
    assert [row.n_tokens for row in got] == wanted


SECRET_TEXTS = [
    "mail jo.doe7@mail.example.com or Jo.Doe7@mail.example.com now",
    "call +1 (523) 555-7040, card 4183418637171908, host 154.127.37.204.",
    'token = "463a598be7e762208ac6a4730a37634729cbd1d2" and 192.168.0.7 and 078-05-1120',
    "Mr Smith met Mrs Smith and Frau Müller; Herr Müller, господин Иванов",
    "under CC BY-NC 4.0. version 3. Apache License, Version 2.0. 1,000 of 12-13",
    "4111 1111 1111 1111 and GB29NWBK60161331926819",
]


def test_pii(spark, empty):
    data = [(i, t) for i, t in enumerate(SECRET_TEXTS)] + [(9, None), (None, SECRET_TEXTS[0]), (2, SECRET_TEXTS[2])]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as n_entities", "1 as key")
    got = {row.doc_id: row for row in pii.replace_entities(docs, "k").collect()}
    assert got[9].text is None and got[9].n_entities == 0
    assert got[None].text == got[0].text
    assert got[4].text == SECRET_TEXTS[4]
    pairs = {}
    for i, text in enumerate(SECRET_TEXTS):
        for a, b, kind in pii.find_entities(text):
            value = text[a:b]
            new = pii.surrogate(kind, value, "k")
            assert value not in got[i].text and new in got[i].text
            assert pairs.setdefault((kind, value), new) == new
            if kind not in ("ip", "secret", "name m", "name f"):
                assert re.sub("[a-zA-Z]", "a", re.sub(r"\d", "9", new)) == re.sub("[a-zA-Z]", "a", re.sub(r"\d", "9", value))
            if kind == "card":
                assert (pii._luhn(re.sub(r"\D", "", value)[:-1]) == int(value[-1])) == (
                    pii._luhn(re.sub(r"\D", "", new)[:-1]) == int(new[-1])
                )
    assert len(set(pairs.values())) == len(pairs) == 15
    assert pii.surrogate("ip", "192.168.0.7", "k").startswith("192.168.")
    assert pii.replace_entities(empty).count() == 0


def test_surrogates_are_distinct(spark):
    assert sorted(pii.permuted(x, 1000, "k") for x in range(1000)) == list(range(1000))
    names = spark.range(3000).selectExpr("'name m' as kind", "concat('N', char(97 + id % 26), id) as value")
    settled = pii.settle_collisions(names, "k").collect()
    assert len({row.surrogate for row in settled}) == len(settled) == 3000
    assert not {row.surrogate for row in settled} & {row.value for row in settled}


def test_entities_take_linear_time():
    for text in ("a@" * 100_000, "1" * 200_000, "1a" * 100_000, "+1 (" * 50_000, "a." * 100_000 + "@b.c"):
        assert len(pii.find_entities(text)) < 100_001
