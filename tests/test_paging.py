import random

import pytest

import snapfeed as sf
from snapfeed.operators.paging import _border, _front
from snapfeed.schema import INDEX_SCHEMA


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    rows = [
        (draw.randrange(60), f"/ifs/{draw.randrange(4)}", "regular", draw.randrange(9), ["a"])
        for _ in range(400)
    ]
    rows += [(30, "/ifs/hot", "regular", 3, ["a"])] * 200
    draw.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def entries(spark, rows):
    return spark.createDataFrame(rows, INDEX_SCHEMA).repartition(7)


def key(row):
    return row[0], row[1], row[3]


@pytest.mark.parametrize("min_rows", [50, 10**6])
def test_order(entries, rows, min_rows):
    found = [tuple(row) for row in sf.ordered(entries, min_rows).collect()]
    assert found == sorted(rows, key=key)


@pytest.mark.parametrize("min_rows", [50, 10**6])
def test_page_numbers(entries, rows, min_rows):
    found = sf.number_pages(entries, 64, min_rows).collect()
    by_position = sorted(found, key=lambda row: row.position)
    assert [row.position for row in by_position] == list(range(len(rows)))
    assert [tuple(row)[:5] for row in by_position] == sorted(rows, key=key)
    assert all(row.page == row.position // 64 for row in found)


def test_no_entries(entries):
    nothing = entries.where("lin < 0")
    assert sf.number_pages(nothing, 10).count() == 0
    assert sf.page_after(nothing, None, 10).count() == 0


@pytest.mark.parametrize(("size", "below"), [(1, 2), (60, 60), (10_000, 60)])
def test_pages_in_turn_give_every_entry_once(entries, rows, size, below):
    entries, rows = entries.where(f"lin < {below}"), [row for row in rows if row[0] < below]
    seen, last = [], None
    while page := sf.page_after(entries, last, size).collect():
        assert len(page) >= min(size, len(rows) - len(seen))
        seen += [tuple(row) for row in page]
        last = (page[-1].lin, page[-1].path)
    assert seen == sorted(rows, key=key)


def test_pages_over_null_keys(make_index):
    rows = [(lin, path, "regular", 1, None) for lin in (None, None, 1, 2) for path in (None, "/a", "/a", "/b")]
    index = make_index(rows)
    for size in (1, 3, 10_000):
        seen, last = [], None
        while page := sf.page_after(index, last, size).collect():
            seen += [(row["lin"], row["path"]) for row in page]
            last = seen[-1]
        assert len(seen) == len(rows)
        rank = [(lin is not None, lin or 0, path is not None, path or "") for lin, path in seen]
        assert rank == sorted(rank)


def test_the_front_of_a_large_index(spark):
    """A page of many rows is taken from few more rows than it has."""
    entries = spark.range(200_000).selectExpr(
        "case when id % 1000 = 0 then null else (id * 7919) % 200000 end as lin",
        "concat('/', id % 5) as path", "'regular' as file_type", "1L as s2", "array('a') as change_types",
    )
    front = _front(entries, 250)
    assert 250 <= front.count() <= 16 * 250
    first = [(r.lin is not None, r.lin or 0) for r in sf.page_after(entries, None, 250).collect()]
    assert first == sorted(first) and len(first) >= 250
    page = sf.page_after(entries, (50_000, "/4"), 250).collect()
    expected = entries.where("lin > 50000 or (lin = 50000 and path > '/4')").orderBy("lin", "path").limit(250)
    assert [(r.lin, r.path) for r in page] == [(r.lin, r.path) for r in expected.collect()]


def test_one_number_in_nearly_all_entries(spark):
    entries = spark.range(5000).selectExpr("3L as lin", "concat('/', id) as path", "1L as s2")
    assert sf.page_after(entries, None, 20).count() == 20


def test_the_border_comes_from_one_range(spark, make_index):
    """Nearly all entries share a number: still no task sorts more than a range of them."""
    rows = [(3, f"/ifs/{n % 500:03}", "regular", n % 7, None) for n in range(4000)] + [(None, None, "regular", 1, None), (9, "/z", "regular", 1, None)]
    index = make_index(rows).repartition(6)
    wanted = sorted(((lin is not None, lin or 0), path or "") for lin, path, *_ in rows)
    for size in (1, 7, 2000, 4002, 9000):
        found, end = _border(index, size, min_rows=100)
        assert found == 4002
        if size >= 9000:
            assert end is None
        else:
            lin, path = end
            assert ((lin is not None, lin or 0), path or "") == wanted[size - 1]
    assert _border(index.limit(0), 5) == (0, None)
