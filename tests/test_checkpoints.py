from concurrent.futures import ThreadPoolExecutor

import pytest

import snapfeed as sf

KEY = ("app", "folder_paths", "/ifs/a", 1)


@pytest.fixture
def log(spark, tmp_path):
    return sf.CheckpointLog(spark, str(tmp_path / "log"))


def test_a_log_that_was_never_written(log):
    assert log.read().count() == 0
    assert log.last_snapshot(*KEY) == -1


def test_a_checkpoint_never_moves_back(log):
    assert log.commit(*KEY, 5)
    assert not log.commit(*KEY, 5)
    assert not log.commit(*KEY, 3)
    assert log.last_snapshot(*KEY) == 5
    assert log.read().count() == 1
    assert log.commit(*KEY, 6)
    assert log.last_snapshot(*KEY) == 6


def test_a_first_commit_at_snapshot_zero_counts(log):
    assert log.commit(*KEY, 0)
    assert log.last_snapshot(*KEY) == 0


def test_minus_one_is_never_written(log):
    assert not log.commit(*KEY, -1)
    assert log.read().count() == 0


def test_every_part_of_the_key_matters(log):
    log.commit(*KEY, 5)
    for other in (
        ("app2", "folder_paths", "/ifs/a", 1),
        ("app", "datasets", "/ifs/a", 1),
        ("app", "folder_paths", "/ifs/b", 1),
        ("app", "folder_paths", "/ifs/a", 2),
    ):
        assert log.last_snapshot(*other) == -1
        log.commit(*other, 9)
    assert log.last_snapshot(*KEY) == 5
    assert log.current().count() == 5


def test_commits_at_the_same_time_all_count(log):
    keys = [("app", "folder_paths", f"/ifs/{n % 4}", 1, n) for n in range(16)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda key: log.commit(*key), keys))
    current = {row.scope: row.snapshot for row in log.current().collect()}
    assert current == {"/ifs/0": 12, "/ifs/1": 13, "/ifs/2": 14, "/ifs/3": 15}


def test_compacted_log(log, tmp_path):
    for snapshot in (1, 4, 7):
        log.commit(*KEY, snapshot)
    log.commit("app", "datasets", "d", 1, 2)
    compact = log.compact_to(str(tmp_path / "compact"))
    assert sorted(compact.read().collect()) == sorted(log.current().collect())
    assert compact.commit(*KEY, 8)
    assert compact.last_snapshot(*KEY) == 8
    assert log.last_snapshot(*KEY) == 7


def test_a_broken_log_is_an_error(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        sf.CheckpointLog(spark, str(tmp_path / "log")).last_snapshot(*KEY)


def test_a_lookup_reads_the_files_of_its_key(spark, tmp_path):
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    for scope in ("/a", "/b", "/c"):
        assert log.commit("app", "folder_paths", scope, 1, 5)
    assert len(list((tmp_path / "log").glob("key=*"))) == 3
    assert log.last_snapshot("app", "folder_paths", "/b", 1) == 5
    for file in (tmp_path / "log").glob("key=*/*/*.parquet"):
        if log._folder("app", "folder_paths", "/b", 1) not in str(file):
            file.write_bytes(b"never opened")
    assert log.last_snapshot("app", "folder_paths", "/b", 1) == 5
    assert log.last_snapshot("app", "folder_paths", "/d", 1) == -1


def test_commits_of_an_older_log_count(spark, tmp_path):
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    old = spark.createDataFrame([("app", "folder_paths", "/a", 1, 7)], log.read().schema)
    old.write.parquet(str(tmp_path / "log" / "commit=0"))
    assert log.last_snapshot("app", "folder_paths", "/a", 1) == 7
    assert not log.commit("app", "folder_paths", "/a", 1, 6)
    assert log.commit("app", "folder_paths", "/a", 1, 8) and log.current().first().snapshot == 8
