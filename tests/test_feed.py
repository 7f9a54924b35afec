import pytest

import snapfeed as sf

ALL = sf.FolderScope("/ifs")


@pytest.fixture
def index(make_index):
    rows = [(s, f"/ifs/f{s}", "regular", s, ["ENTRY_ADDED"]) for s in (-2, 0, 1, 5, 9)]
    rows += [
        (20, "/ifs/both", "regular", 5, ["ENTRY_ADDED", "ENTRY_DELETED"]),
        (21, "/ifs/gone", "regular", 5, ["ENTRY_DELETED"]),
        (22, "/ifs/other", "regular", 5, None),
        (23, "/ifs/unknown", "regular", None, ["ENTRY_ADDED"]),
        (24, "/ifs/dir", "directory", 9, ["ENTRY_ADDED"]),
        (25, "/other/x", "regular", 9, ["ENTRY_ADDED"]),
    ]
    return sf.sources.index.with_change_list(make_index(rows))


def paths(df):
    return sorted(row.path for row in df.collect())


@pytest.mark.parametrize(
    ("low", "high", "expected"),
    [
        (-1, 9, {"f0", "f1", "f5", "f9", "both", "gone", "other"}),
        (0, 9, {"f1", "f5", "f9", "both", "gone", "other"}),
        (1, 5, {"f5", "both", "gone", "other"}),
        (5, 5, set()),
        (9, 20, set()),
        (-1, -1, set()),
    ],
)
def test_range_is_open_below_and_closed_above(index, low, high, expected):
    found = paths(sf.directory_changes(index, ALL, low, high))
    assert found == sorted(f"/ifs/{name}" for name in expected)


def test_feed_columns(index):
    feed = sf.directory_changes(index, ALL, -1, 9)
    assert feed.columns == ["path", "snapshot", "change_types"]
    assert feed.where("path = '/ifs/other'").first().change_types == []


def test_latest_snapshot_is_over_the_whole_index(index, make_index):
    assert sf.latest_snapshot(index) == 9
    assert sf.latest_snapshot(index.where("file_type = 'directory'")) == 9
    assert sf.latest_snapshot(make_index([])) == -1
    assert sf.latest_snapshot(make_index([(1, "/ifs/a", "regular", None, None)])) == -1


def test_additions_and_deletions_may_be_the_same_row(index):
    feed = sf.directory_changes(index, ALL, 1, 9)
    assert paths(sf.new_files(feed)) == ["/ifs/both", "/ifs/f5", "/ifs/f9"]
    assert paths(sf.deleted_files(feed)) == ["/ifs/both", "/ifs/gone"]
    assert sf.new_files(feed).columns == ["path", "snapshot"]


def test_all_files_are_the_additions_after_snapshot_zero(index):
    assert paths(sf.all_files(index, ALL)) == ["/ifs/both", "/ifs/f1", "/ifs/f5", "/ifs/f9"]


def test_scope_scan_has_every_snapshot(index):
    found = paths(sf.scan_scope(index, ALL))
    assert {"/ifs/f-2", "/ifs/f0", "/ifs/unknown"} <= set(found)
    assert "/ifs/dir" not in found and "/other/x" not in found


def test_documents_are_empty_and_carry_the_file(index):
    row = sf.document_feed(sf.directory_changes(index, ALL, 5, 9)).first()
    assert row.page_content == ""
    assert row.metadata.asDict() == {
        "source": "/ifs/f9",
        "snapshot": 9,
        "change_types": ["ENTRY_ADDED"],
    }


def test_equal_entries_are_all_delivered(make_index):
    index = make_index([(1, "/ifs/a", "regular", 1, ["ENTRY_ADDED"])] * 3)
    assert sf.directory_changes(index, ALL, 0, 1).count() == 3


@pytest.mark.parametrize("format", ["json", "parquet", "orc"])
def test_nested_index_files(spark, index, tmp_path, format):
    path = str(tmp_path / format)
    sf.nest_index(index).write.format(format).save(path)
    stored = sf.read_index(spark, path, format)
    assert stored.columns == index.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, index.collect()))


def test_absent_json_fields(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"data": {"path": "/ifs/a", "lin": 1, "file_type": "regular"},'
        ' "metadata": {"snapshots": {"s2": 3}}, "more": 1}\n'
        '{"data": {"path": "/ifs/b", "lin": 2, "file_type": "regular"}}\n'
    )
    rows = sorted(sf.read_index(spark, str(tmp_path), "json").collect())
    assert [tuple(r) for r in rows] == [
        (1, "/ifs/a", "regular", 3, []),
        (2, "/ifs/b", "regular", None, []),
    ]


def test_the_condition_reaches_the_scan(spark, index, tmp_path, plan_of):
    sf.write_index(index, str(tmp_path / "flat"))
    flat = sf.read_index(spark, str(tmp_path / "flat"), nested=False)
    sf.nest_index(index).write.parquet(str(tmp_path / "nested"))
    nested = sf.read_index(spark, str(tmp_path / "nested"))
    for stored, prefix in ((flat, ""), (nested, "data.")):
        plan = plan_of(sf.new_files(sf.directory_changes(stored, sf.FolderScope("/ifs/f"), 1, 9)))
        pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
        assert f"EqualTo({prefix}file_type,regular)" in pushed
        assert f"StringStartsWith({prefix}path,/ifs/f)" in pushed
        assert "GreaterThan(" in pushed and "LessThanOrEqual(" in pushed
        assert "Exchange" not in plan
        schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
        assert "lin" not in schema


@pytest.mark.parametrize(
    ("mode", "pushed"),
    [
        ("subtree", "Or(EqualTo(path,/ifs/f),StringStartsWith(path,/ifs/f/))"),
        ("phrase", "StringContains(path,/ifs/f)"),
    ],
)
def test_folder_modes_reach_the_scan(spark, index, tmp_path, plan_of, mode, pushed):
    sf.write_index(index, str(tmp_path / "i"))
    stored = sf.read_index(spark, str(tmp_path / "i"), nested=False)
    assert pushed in plan_of(sf.scan_scope(stored, sf.FolderScope("/ifs/f", mode)))


def test_latest_snapshot_from_footers(spark, index, tmp_path, plan_of):
    sf.write_index(index, str(tmp_path / "i"))
    settings = {
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.sources.useV1SourceList": "",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        stored = sf.read_index(spark, str(tmp_path / "i"), nested=False)
        plan = plan_of(sf.operators.feed.latest_snapshot_row(stored))
        assert "PushedAggregation: [MAX(s2)]" in plan
        assert sf.latest_snapshot(stored) == 9
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_layout_keeps_ranges_of_snapshots_apart(spark, make_index, tmp_path):
    index = make_index(
        [
            (i, f"/ifs/f{i:04}", "regular", 0 if i < 300 else i % 7, ["ENTRY_ADDED"])
            for i in range(400)
        ]
    )
    sf.write_index(index, str(tmp_path / "i"), partitions=4)
    stored = sf.read_index(spark, str(tmp_path / "i"), nested=False)
    assert sorted(map(str, stored.collect())) == sorted(map(str, index.collect()))
    files = stored.where("s2 = 0").selectExpr("_metadata.file_path as f").distinct().count()
    late = stored.where("s2 = 6").selectExpr("_metadata.file_path as f").distinct().count()
    assert files >= 3 and late == 1
