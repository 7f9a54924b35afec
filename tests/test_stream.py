import pytest

import snapfeed as sf

SCOPE = sf.FolderScope("/ifs/a")


@pytest.fixture
def drops(make_index, tmp_path):
    path = str(tmp_path / "drops")

    def add(*rows):
        index = make_index(list(rows)).coalesce(1)
        sf.nest_index(index).write.mode("append").parquet(path)

    add.path = path
    return add


def row(lin, snapshot, folder="a", kind="regular", changes=None):
    return lin, f"/ifs/{folder}/{lin}", kind, snapshot, changes


def test_each_start_takes_what_is_new_and_all_starts_equal_the_batch(spark, drops, tmp_path):
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")

    def start():
        feed = sf.stream_changes(sf.read_index_stream(spark, drops.path), SCOPE)
        sf.write_available(feed, state, sink=sink, timeout=120)
        return sorted(r.path for r in spark.read.parquet(sink).collect())

    drops(row(1, 0), row(2, 1, "b"), row(3, 1, kind="directory"))
    assert start() == ["/ifs/a/1"]
    drops(row(4, 2, changes=["ENTRY_ADDED"]), row(5, 0))
    assert start() == ["/ifs/a/1", "/ifs/a/4", "/ifs/a/5"]
    assert start() == ["/ifs/a/1", "/ifs/a/4", "/ifs/a/5"]
    index = sf.read_index(spark, drops.path)
    batch = sf.directory_changes(index, SCOPE, -1, sf.latest_snapshot(index))
    assert sorted(map(str, batch.collect())) == sorted(map(str, spark.read.parquet(sink).collect()))


def test_batches_with_content_and_a_lower_bound(spark, drops, tmp_path):
    content = spark.createDataFrame(
        [(f"/ifs/a/{n}", f"text {n}") for n in range(6)], "path string, content string"
    )
    batches = {}

    def take(batch, number):
        documents = sf.load_documents(batch, content)
        batches[number] = sorted(r.page_content for r in documents.collect())

    for lin in range(4):
        drops(row(lin, lin))
    entries = sf.read_index_stream(spark, drops.path, files_per_batch=2)
    feed = sf.stream_changes(entries, SCOPE, low=0)
    sf.write_available(feed, str(tmp_path / "state"), each_batch=take, timeout=120)
    assert len(batches) == 2
    assert sorted(sum(batches.values(), [])) == ["text 1", "text 2", "text 3"]


def test_a_failed_batch_comes_again(spark, drops, tmp_path):
    calls = []

    def take(batch, number):
        calls.append((number, sorted(r.path for r in batch.collect())))
        if len(calls) == 1:
            raise RuntimeError("sink is down")

    def start():
        feed = sf.stream_changes(sf.read_index_stream(spark, drops.path), SCOPE)
        sf.write_available(feed, str(tmp_path / "state"), each_batch=take, timeout=120)

    drops(row(1, 1))
    with pytest.raises(Exception, match="sink is down"):
        start()
    start()
    assert calls == [(0, ["/ifs/a/1"])] * 2


def test_one_target_only(spark, drops):
    drops(row(1, 1))
    feed = sf.stream_changes(sf.read_index_stream(spark, drops.path), SCOPE)
    for targets in ({}, {"sink": "x", "each_batch": print}):
        with pytest.raises(ValueError):
            sf.write_available(feed, "state", **targets)


def test_batches_by_snapshot(spark, make_index, tmp_path):
    """Late rows are passed over as by batch runs, and a batch that failed comes again with the same rows."""
    table = sf.IndexTable(spark, str(tmp_path / "index"))
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    batches, runs, failing = [], [], [True]

    def take(batch, number):
        if failing and number == 1:
            failing.clear()
            # written between the attempts, with a snapshot of the batch's range
            table.append(make_index([row(50, 4)]))
            raise RuntimeError("sink is down")
        batches.append((number, sorted((r.path, r.snapshot) for r in batch.collect())))

    def start():
        feed = sf.stream_changes(sf.read_snapshot_stream(spark, table.path), SCOPE)
        sf.write_available(feed, str(tmp_path / "state"), each_batch=take, timeout=120)

    def run():
        with sf.IncrementalRun(table, log, SCOPE) as batch:
            runs.append(sorted((r.path, r.snapshot) for r in batch.changes().collect()))

    table.append(make_index([row(1, 0), row(2, 3), row(3, 3, "b"), row(4, None)]))
    start()
    run()
    table.append(make_index([row(5, 2), row(6, 4), row(7, 5, changes=["ENTRY_ADDED"])]))
    run()
    with pytest.raises(Exception, match="sink is down"):
        start()
    start()
    start()
    # a write of late rows alone makes a batch without rows
    assert batches[:2] == [(0, [("/ifs/a/1", 0), ("/ifs/a/2", 3)]), (1, [("/ifs/a/6", 4), ("/ifs/a/7", 5)])]
    assert [rows for _, rows in batches[2:] if rows] == []
    assert runs == [rows for _, rows in batches[:2]]


def test_a_stream_by_snapshots_may_begin_later(spark, make_index, tmp_path):
    table = sf.IndexTable(spark, str(tmp_path / "index"))
    sink = str(tmp_path / "sink")
    for number in range(3):
        table.append(make_index([row(10 * number + n, n) for n in range(6)]), partitions=2)
    feed = sf.stream_changes(sf.read_snapshot_stream(spark, f"file://{table.path}", low=3, files_per_task=1), SCOPE)
    sf.write_available(feed, str(tmp_path / "state"), sink=sink, timeout=120)
    assert sorted(r.snapshot for r in spark.read.parquet(sink).collect()) == [4] * 3 + [5] * 3
