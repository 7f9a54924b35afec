"""The stages of the pipeline against plain Python, on a table with repeated, shared and null ids."""

import collections
import random

import pytest

import corpus_pipeline
from snapfeed.llm import pii

SCHEMA = "doc_id long, text string, source string"


def words(draw, n):
    return [draw.choice("ta ba lo mi ko re sa nu ve di".split()) + draw.choice("n r s t l".split()) + str(draw.randrange(9)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(12)
    base = [words(draw, 60) for _ in range(12)]
    near = [[*w[:58], "x", "y"] for w in base]
    texts, close = ([" ".join(w) for w in x] for x in (base, near))
    out = [(10 + i, text, "s") for i, text in enumerate(texts[:8])]
    out += [out[0], out[0], (11, texts[1], "other"), (3, close[2], "s"), (40, texts[3], "s")]
    out += [(None, texts[4], "s"), (None, close[5], "s")]  # copies of rows with an id
    out += [(None, texts[8], "s")] * 3 + [(None, close[8], "s")]  # among themselves
    out += [(50, texts[9], "s"), (50, close[9], "s"), (51, texts[10], "s"), (51, texts[11], "s")]  # shared ids
    out += [(60, "", "s"), (61, "", "s"), (61, "", "s"), (None, None, "s"), (None, None, "s"), (62, None, "s")]
    return out


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(rows):
    """Distinct (id, text) rows by near copies."""
    own = list(dict.fromkeys((i, text) for i, text, *_ in rows))
    sets = {x: shingles(x[1]) for x in own}
    of = {x: {x} for x in own}
    for a in own:
        for b in own:
            x, y = sets[a], sets[b]
            if a != b and x and y and 100 * len(x & y) >= 75 * len(x | y) and of[a] is not of[b]:
                whole = of[a] | of[b]
                of |= dict.fromkeys(whole, whole)
    return {id(g): g for g in of.values()}.values()


def test_near_dedup(spark, rows):
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), "")
    assert got.columns == ["doc_id", "text", "source"]
    kept = collections.Counter((row.doc_id, row.text) for row in got.collect())
    assert max(kept.values()) == 1
    for group in groups(rows):
        least = min((i is None, i or 0) for i, _ in group)
        (one,) = group & kept.keys()
        assert (one[0] is None, one[0] or 0) == least
    assert corpus_pipeline.near_dedup(spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def counted(df):
    return collections.Counter((row.doc_id, row.text, row.source) for row in df.collect())


def test_quality_stage(spark, rows, tmp_path):
    """Without labels the forest rejects nothing, and the base rule alone decides."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    short, repeated = "one two three", "a b c d e f g h " * 9
    rows = [*rows, (70, short, "s"), (None, short, "s"), (71, repeated, "s"), (71, repeated, "s"), (None, repeated, "s")]

    def sound(text):
        w = (text or "").split()
        windows = collections.defaultdict(list)
        for i in range(len(w) - 7):
            windows[tuple(w[i : i + 8])].append(i)
        again = {k for places in windows.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
        return len(w) >= 20 and 100 * len(again) <= 30 * len(w)

    got = counted(corpus_pipeline.quality(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), str(tmp_path)))
    assert got == collections.Counter(row for row in rows if sound(row[1]))


def test_decontamination_stage(spark, rows, tmp_path):
    item = (rows[0][1].split())[10:40]
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    swapped = " ".join([*item[15:], *item[:15]])
    rows = [*rows, (80, "so " * 9 + swapped, "s"), (80, "so " * 9 + swapped, "s"), (None, rows[0][1], "s"), (None, rows[0][1], "s")]

    def grams(w):
        return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))

    def clean(text):
        w, x = (text or "").split(), grams(item)
        windows = (grams(w[i : i + 30]) for i in range(max(1, len(w) - 29)))
        return not any(100 * (c & x).total() >= 75 * (c | x).total() for c in windows)

    got = counted(corpus_pipeline.decontamination(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), str(tmp_path)))
    assert got == collections.Counter(row for row in rows if clean(row[1]))
    assert sum(got.values()) < len(rows)


def test_pii_stage(spark, rows):
    secret = "mail jo.doe7@mail.example.com or call +1 (523) 555-7040 now"
    rows = [*rows, (90, secret, "s"), (90, secret, "s"), (None, secret, "s")]

    def replaced(text):
        out, at = "", 0
        for a, b, kind in sorted(pii.find_entities(text or "")):
            out, at = out + text[at:a] + pii.surrogate(kind, text[a:b], pii.KEY), b
        return None if text is None else out + text[at:]

    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "length(text) as n_chars").repartition(4)
    got = corpus_pipeline.pii(spark, docs, "")
    assert got.columns == docs.columns and replaced(secret) != secret
    assert counted(got) == collections.Counter((i, replaced(text), source) for i, text, source in rows)
    assert got.where("not n_chars <=> length(text)").count() == 0


def test_mixing_stage(spark, rows):
    """Weights 1, 2 and 3 for three sources; what a source lacks at three copies goes to the others."""
    rows = [(i, text, ["a", "b", None][k % 3]) for k, (i, text, _) in enumerate(rows)] + [(95, "x " * 30, "b")] * 2
    sizes, largest, taken = collections.Counter(), collections.Counter(), collections.Counter()
    for _, text, source in rows:
        n = len((text or "").split())
        sizes[source] += n
        largest[source] = max(largest[source], n)
    goal, left = {}, {"a": 1, "b": 2, None: 3}
    while True:
        level = (sum(sizes.values()) - sum(goal.values())) / sum(left.values())
        over = [s for s in left if left[s] * level > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            goal[s] = 3 * sizes[s]
            del left[s]
    goal |= {s: w * level for s, w in left.items()}
    got = corpus_pipeline.mixing(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), "").collect()
    assert not collections.Counter((row.doc_id, row.text, row.source) for row in got) - collections.Counter(rows)
    for row in got:
        assert row["size"] == len((row.text or "").split()) and 1 <= row.copies <= 3 and row.taken == row.copies * row["size"]
        taken[row.source] += row.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 0.5 * largest[s] + 1
        at_least_once = [x for x in rows if x[2] == s and x[1] and x[1].split()] if goal[s] >= sizes[s] else []
        assert not collections.Counter(at_least_once) - collections.Counter((r.doc_id, r.text, r.source) for r in got)
