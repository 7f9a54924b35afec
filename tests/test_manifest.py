import json
from concurrent.futures import ThreadPoolExecutor

import pytest

import snapfeed as sf
from snapfeed.sources import manifest
from snapfeed.sources.versions import Store, Versions

SCOPE = sf.FolderScope("/ifs/a")


def entry(lin, snapshot, folder="a"):
    return lin, f"/ifs/{folder}/{lin:04}", "regular", snapshot, ["ENTRY_ADDED"]


@pytest.fixture
def table(spark, tmp_path):
    return sf.IndexTable(spark, str(tmp_path / "index"))


@pytest.fixture
def log(spark, tmp_path):
    return sf.CheckpointLog(spark, str(tmp_path / "log"))


def test_one_writer_wins_each_version(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.read() == (0, None)
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda n: versions.change(lambda state: (state or []) + [n]), range(40)))
    assert all(done)
    number, state = versions.read()
    assert sorted(state) == list(range(40)) and number == 40
    assert len(versions._numbers()) <= 10 and not [n for n in versions.store.names() if n.startswith("_draft")]
    assert not versions.change(lambda state: None)


def test_a_number_that_was_freed_again_loses_nothing(spark, tmp_path):
    """A slow writer puts a version that newer ones have left behind and had removed."""
    versions = Versions(spark, str(tmp_path / "v"))
    versions.change(lambda state: ["a"])
    asked = []

    def slow(state):
        asked.append(state)
        if len(asked) == 1:
            for n in range(12):
                versions.change(lambda state, n=n: [*state, n])
            versions.trim(0)
        return None if "slow" in state else [*state, "slow"]

    assert versions.change(slow)
    assert versions.read()[1] == ["a", *range(12), "slow"]


def test_files_are_put_once(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/with blank")
    assert store.read("x") is None and store.names() == [] and not store.exists("x")
    assert store.put("x", "ä") and not store.put("x", "b")
    assert store.read("x") == "ä" and store.names() == ["x"]
    assert store.put("deep/er", "c") and store.read("deep/er") == "c"


def test_runs_read_what_their_bounds_need(table, log, make_index):
    table.append(make_index([entry(n, n % 4) for n in range(40)]), partitions=4)
    with sf.IncrementalRun(table, log, SCOPE) as run:
        assert (run.low, run.high) == (-1, 3) and run.changes().count() == 40
    table.append(make_index([entry(100 + n, 4 + n % 2) for n in range(10)]), partitions=2)
    run = sf.IncrementalRun(table, log, SCOPE)
    assert (run.low, run.high) == (3, 5)
    files = {row.f for row in run.entries().selectExpr("input_file_name() as f").distinct().collect()}
    assert len(files) <= 2 and len(run._read[3].inputFiles()) <= 2
    assert sorted(row.snapshot for row in run.changes().collect()) == [4] * 5 + [5] * 5
    # what is written after the run has begun is none of its business
    table.append(make_index([entry(200, 5), entry(201, 9)]))
    assert run.changes().count() == 10 and run.all_files().count() == 40
    assert sf.IncrementalRun(table, log, SCOPE).high == 9
    table.check()


def test_ranges_of_paths_and_snapshots(table, make_index):
    assert table.high() == -1 and table.read().count() == 0 and table.files() == []
    rows = [entry(n, n, "ab"[n % 2]) for n in range(8)] + [(90, None, "regular", 3, None), (91, "/ifs/a/x", "regular", None, None)]
    for row in rows:
        table.append(make_index([row]))
    assert table.high() == 7 and table.read().count() == 10
    assert table.read(2, 5).count() == 4
    assert table.read(prefix="/ifs/a").count() == 5 and table.read(prefix="/ifs/a/0004").count() == 1
    assert table.read(5, 7, "/ifs/b").count() == 1 and table.read(7, 9).count() == 0
    assert sorted(map(str, table.read().collect())) == sorted(map(str, table.read().where("true").collect()))


def test_what_nobody_recorded_is_an_error(table, log, make_index, monkeypatch):
    monkeypatch.setattr(manifest, "_WAITS", (0.0,))
    table.append(make_index([entry(1, 1)]))
    make_index([entry(2, 2)]).write.parquet(f"{table.path}/write=lost")
    with pytest.raises(ValueError, match="write=lost"):
        sf.IncrementalRun(table, log, SCOPE).changes()
    assert table.adopt() == ["write=lost"] and table.adopt() == []
    assert table.high() == 2 and table.read().count() == 2
    make_index([entry(3, 3)]).write.mode("append").parquet(f"{table.path}/write=lost")
    with pytest.raises(ValueError, match="differ"):
        table.check()


def test_files_that_lie_in_the_top_folder(spark, table, make_index, monkeypatch):
    monkeypatch.setattr(manifest, "_WAITS", (0.0,))
    make_index([entry(n, n) for n in range(4)]).repartition(2).write.parquet(table.path)
    with pytest.raises(ValueError, match="adopt"):
        table.high()
    assert len(table.adopt()) == 2
    assert table.high() == 3 and table.read().count() == 4
    table.check()


def test_a_write_under_way_is_passed_over(table, make_index, tmp_path):
    table.append(make_index([entry(1, 1)]))
    folder = tmp_path / "index" / "write=now" / "_temporary"
    folder.mkdir(parents=True)
    assert table.high() == 1 and table.adopt() == []


def test_writers_at_the_same_time(table, make_index):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: table.append(make_index([entry(n, n)])), range(6)))
    assert table.read().count() == 6 and table.high() == 5
    table.check()


def test_a_lost_part_of_the_record_is_an_error(table, make_index, tmp_path):
    table.append(make_index([entry(1, 1)]))
    for file in (tmp_path / "index" / "_manifest" / "segments").glob("*.json"):
        assert json.loads(file.read_text())[0]["rows"] == 1
        file.unlink()
    with pytest.raises(ValueError, match="lost"):
        table.read()


def test_many_commits_of_a_key_are_one_file(spark, tmp_path):
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    key = ("app", "folder_paths", "/ifs/a", 1)
    for n in range(1000):
        assert log.commit(*key, n)
    assert log.last_snapshot(*key) == 999
    assert len(list((tmp_path / "log").glob("key=*/_state/*.json"))) <= 9
    log.compact()
    assert len(list((tmp_path / "log").glob("key=*/_state/*.json"))) == 1
    assert [tuple(row) for row in log.read().collect()] == [(*key, 999)]


def test_an_older_log_is_taken_up_while_commits_go_on(spark, tmp_path):
    path = tmp_path / "log"
    log = sf.CheckpointLog(spark, str(path))
    rows = [("app", "folder_paths", f"/ifs/{n % 5}", 1, n) for n in range(50)]
    old = spark.createDataFrame(rows, log.read().schema)
    old.where("snapshot < 30").write.parquet(str(path / "commit=0"))
    own = log._folder("app", "folder_paths", "/ifs/4", 1)
    old.where("scope = '/ifs/4'").write.parquet(f"{own}/commit=1")
    assert log.last_snapshot("app", "folder_paths", "/ifs/4", 1) == 49
    with ThreadPoolExecutor(4) as pool:
        compaction = pool.submit(log.compact)
        list(pool.map(lambda row: log.commit(*row), rows[25:]))
        compaction.result()
    log.compact()
    assert not [x for x in path.rglob("*.parquet")]
    assert {row.scope: row.snapshot for row in log.read().collect()} == {f"/ifs/{n}": 45 + n for n in range(5)}
    assert log.read().count() == 5
