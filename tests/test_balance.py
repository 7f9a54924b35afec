import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import snapfeed as sf
from snapfeed.balance import fold_copies, measure, row_bytes, unfold_copies

LEFT = "path string, snapshot bigint, change_types array<string>"


@pytest.fixture(scope="module")
def feed(spark):
    """A third of the rows has one path, most of them equal; some have no path."""
    draw = random.Random(3)
    rows = [(f"/p{draw.randrange(300)}", draw.randrange(3), ["a"]) for _ in range(3000)]
    rows += [("/hot", 1, ["a"])] * 1200 + [("/hot", n, ["b"]) for n in range(300)]
    rows += [(None, 1, None)] * 40
    draw.shuffle(rows)
    return spark.createDataFrame(rows, LEFT).coalesce(4)


@pytest.fixture(scope="module")
def content(spark):
    rows = [(f"/p{n}", f"text {n}") for n in range(0, 400, 2)]
    rows += [("/hot", "one"), ("/hot", "two"), ("/p2", "again"), (None, "none")]
    return spark.createDataFrame(rows, "path string, content string").coalesce(3)


def counted(df):
    return Counter(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("min_rows", [100, 10**6])
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 30])
def test_same_rows_as_a_plain_join(feed, content, how, min_rows, broadcast_bytes):
    joined = sf.balanced_join(feed, content, "path", how, min_rows, broadcast_bytes)
    expected = feed.join(content, "path", how)
    assert joined.columns == expected.columns
    assert counted(joined) == counted(expected)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 30])
def test_unique_right_side(feed, content, broadcast_bytes, plan_of):
    unique = content.groupBy("path").count()
    joined = sf.balanced_join(
        feed, unique, "path", "left", 100, broadcast_bytes, unique_right=True
    )
    assert counted(joined) == counted(feed.join(unique, "path", "left"))
    if broadcast_bytes:
        assert "_salt" not in plan_of(joined)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_empty_sides(feed, content, how):
    nothing, none = feed.where("snapshot < 0"), content.where("content = ''")
    assert sf.balanced_join(nothing, content, "path", how).count() == 0
    expected = feed.count() if how in ("left", "left_anti") else 0
    assert sf.balanced_join(feed, none, "path", how).count() == expected


def test_measure(feed):
    size = measure(feed, ["path"], 100)
    assert size.rows == feed.count()
    assert (size.low, size.high) == ("/hot", "/p99")
    assert size.tasks == 8
    # 1,500 of 4,540 rows, where one task in eight should have 568.
    assert list(size.heavy.values()) == [3]
    assert measure(feed, ["path"]).heavy == {}
    text = sum(len(r.path or "") + len(",".join(r.change_types or [])) for r in feed.collect())
    assert size.bytes == text + size.rows * (16 + 3 * 8 + 8)


def test_the_hot_key_is_dealt_out(feed, content):
    joined = sf.balanced_join(feed, content, "path", "inner", 100, 0)
    parts = (
        joined.where("path = '/hot'").selectExpr("spark_partition_id() as p").groupBy("p").count()
    )
    assert feed.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    feed.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert parts.count() >= 2
    finally:
        feed.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_equal_rows_lie_in_several_ranges(spark, monkeypatch):
    monkeypatch.setattr("snapfeed.balance.MAX_COPIES", 100)
    rows = [("hot", 1)] * 1600 + [(f"p{n}", n) for n in range(800)]
    df = spark.createDataFrame(rows, "x string, y int").coalesce(3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = sf.range_sorted(df, ["x"], min_rows=50)
        sizes = [
            r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == len(rows) and max(sizes) < 600
    in_order = [r.x for r in sf.range_sorted(df, ["x"], min_rows=50).collect()]
    assert in_order == sorted(x for x, _ in rows)


def test_equal_rows_fold_and_unfold(spark, monkeypatch):
    monkeypatch.setattr("snapfeed.balance.MAX_COPIES", 7)
    rows = [("a", 1)] * 50 + [("b", 2)] + [(None, None)] * 7
    df = spark.createDataFrame(rows, "x string, y int")
    folded = fold_copies(df, ["x", "y"])
    assert sorted(r._copies for r in folded.collect()) == [1, 1, 7, 7, 7, 7, 7, 7, 7, 7]
    assert counted(unfold_copies(folded).select("x", "y")) == counted(df)


def test_the_strategy_follows_the_measured_size(feed, content, plan_of, monkeypatch):
    small = plan_of(sf.balanced_join(feed, content, "path", "inner"))
    assert "BroadcastHashJoin Inner BuildLeft" in small
    assert "hashpartitioning" not in small
    large = plan_of(sf.balanced_join(feed, content, "path", "inner", broadcast_bytes=0))
    assert "ShuffledHashJoin Inner BuildLeft" in large
    monkeypatch.setattr("snapfeed.balance.HASH_TABLE_BYTES", 0)
    larger = plan_of(sf.balanced_join(feed, content, "path", "inner", broadcast_bytes=0))
    assert "SortMergeJoin Inner" in larger


def test_nested_texts_are_measured(spark):
    wide = spark.range(1000).selectExpr("id", "named_struct('t', repeat('x', 2000)) as s", "map('k', repeat('y', 500)) as m")
    measured = wide.agg(F.sum(row_bytes(wide.schema))).first()[0]
    assert measured > 2_500_000
