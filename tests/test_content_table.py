"""Content in buckets of its path."""

import re
from collections import Counter

import pytest

import snapfeed as sf
from snapfeed.operators.content import load_documents, outcomes

FEED = "path string, snapshot bigint, change_types array<string>"


@pytest.fixture(scope="module")
def rows():
    feed = [(f"/f{n % 50}", n, []) for n in range(400)] + [("/f3", n, ["ENTRY_ADDED"]) for n in range(400, 1000)] + [(None, 1, None)]
    content = [(f"/f{n}", f"text {n}" if n % 7 else None) for n in range(40)] + [("/f1", "again"), ("/f'x", "")]
    return feed, [*content, *(("/f2", f"long {n}" * 10) for n in range(60))]


@pytest.fixture
def table(spark, rows, tmp_path):
    made = sf.ContentTable(spark, str(tmp_path / "it's content"))
    content = spark.createDataFrame([*rows[1], (None, "lost")], "path string, content string")
    made.write(content.where("path < '/f2'"), buckets=5)
    made.write(content.where("path >= '/f2' or path is null"), bucket_bytes=500)
    return made


@pytest.mark.parametrize(("broadcast_bytes", "min_rows"), [(1 << 20, 10_000), (0, 10_000), (0, 50), (1 << 20, 50)])
def test_same_rows_as_a_plain_join(spark, rows, table, broadcast_bytes, min_rows):
    feed = spark.createDataFrame(rows[0], FEED)
    got = table.join(feed, broadcast_bytes, min_rows).select("path", "snapshot", "content").collect()
    wanted = Counter((p, s, text) for p, s, _ in rows[0] for path, text in rows[1] if p == path)
    assert Counter(map(tuple, got)) == wanted
    assert table.buckets() == 5
    assert table.spark.read.parquet(f"{table.path}/repeated").select("path").distinct().count() == 1
    assert Counter(map(tuple, table.read().collect())) == Counter(rows[1])


def test_nothing_of_the_content_is_shuffled(spark, rows, table, plan_of):
    feed = spark.createDataFrame([row for row in rows[0] if row[0] != "/f3"], FEED).repartition(3)
    plan = plan_of(table.join(feed, 0).where("content <> ''"))
    tree = plan.split("\n\n")[0].splitlines()
    scan = next(i for i, line in enumerate(tree) if "Scan parquet" in line and "snapfeed_content" in line)

    def depth(line):
        return len(re.match(r"[\s:|+*-]*", line)[0])

    above, at = [], depth(tree[scan])
    for line in reversed(tree[:scan]):  # the scan's ancestors
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    join = next(i for i, line in enumerate(above) if "Join" in line)
    assert "ShuffledHashJoin" in above[join] and not any("Exchange" in line or "Sort" in line for line in above)
    assert "Bucketed: true" in plan and re.search(r"SelectedBucketsCount: 5 out of 5", plan)


def test_hot_paths_open_their_bucket_only(spark, rows, table, plan_of):
    feed = spark.createDataFrame(rows[0], FEED)
    plan = plan_of(table.join(feed, 0, 50))
    assert "SelectedBucketsCount: 1 out of 5" in plan


def test_another_session_reads_it(spark, rows, table):
    other = spark.newSession()
    feed = other.createDataFrame(rows[0], FEED)
    again = sf.ContentTable(other, table.path)
    other.sql(f"drop table {again._table()}")
    assert again.join(feed, 0).count() == table.join(spark.createDataFrame(rows[0], FEED), 0).count() > 0


def test_documents_outcomes_and_loader(spark, rows, table, make_index, tmp_path):
    feed, content = (spark.createDataFrame(r, s) for r, s in zip(rows, (FEED, "path string, content string"), strict=True))
    assert Counter(map(str, load_documents(feed, table).collect())) == Counter(map(str, load_documents(feed, content).collect()))
    assert Counter(map(str, outcomes(feed, table).collect())) == Counter(map(str, outcomes(feed, content).collect()))
    index = make_index([(n, f"/ifs/f{n}", "regular", n, ["ENTRY_ADDED"]) for n in (1, 2, 3)])
    held = sf.ContentTable(spark, str(tmp_path / "held"))
    held.write(spark.createDataFrame([("/ifs/f1", "one\ntwo"), ("/ifs/f2", None)], "path string, content string"))
    loader = sf.ContentLoader(index, sf.CheckpointLog(spark, str(tmp_path / "log")), "/ifs", mode="elements", content=held)
    assert sorted(r.page_content for r in loader.load().collect()) == ["one", "two"]
    assert {(r.path, r.error) for r in loader.outcomes().collect()} == {("/ifs/f1", None), ("/ifs/f2", "unreadable"), ("/ifs/f3", "missing")}


def test_empty_sides(spark, table, tmp_path):
    nothing = spark.createDataFrame([], FEED)
    assert table.join(nothing).count() == table.join(nothing, 0).count() == 0
    empty = sf.ContentTable(spark, str(tmp_path / "empty"))
    with pytest.raises(ValueError):
        empty.read()
    with pytest.raises(ValueError):
        empty.write(table.read(), buckets=0)
    empty.write(table.read().limit(0))
    assert empty.buckets() == 1 and empty.read().count() == 0
    assert empty.join(spark.createDataFrame([("/f1", 1, [])], FEED), 0).count() == 0
