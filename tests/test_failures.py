import pytest

import snapfeed as sf
from snapfeed.sources.failures import FAILURE_SCHEMA, merged

KEY = ("app", "folder_paths", "/ifs/a", 1)


@pytest.fixture
def ledger(spark, tmp_path):
    return sf.FailureLedger(spark, str(tmp_path / "ledger"))


def feed_of(spark, *rows):
    return spark.createDataFrame([(p, s, k) for p, s, k in rows], "path string, snapshot long, change_types array<string>")


def outcomes_of(spark, *rows):
    return spark.createDataFrame([(p, s, e is None, e) for p, s, e in rows], "path string, snapshot long, ok boolean, error string")


def rows(df):
    return sorted((r.path, r.snapshot, r.error, r.attempts) for r in df.collect())


def test_failures_stay_open_until_they_are_read(spark, ledger):
    assert rows(ledger.open(*KEY)) == []
    feed = feed_of(spark, ("/a", 1, ["ENTRY_ADDED"]), ("/b", 1, None), ("/c", 1, ["ENTRY_DELETED"]), ("/c", 2, ["ENTRY_DELETED", "ENTRY_ADDED"]))
    outcomes = outcomes_of(spark, ("/a", 1, "unreadable"), ("/b", 1, None), ("/c", 1, "missing"), ("/c", 2, "missing"))
    ledger.record(*KEY, feed, outcomes)
    assert rows(ledger.open(*KEY)) == [("/a", 1, "unreadable", 1), ("/c", 2, "missing", 1)]
    assert ledger.open("app", "folder_paths", "/ifs/a", 2).count() == 0
    # what was tried again counts on, what was not stays, what was read goes
    ledger.record(*KEY, feed_of(spark, ("/a", 1, ["ENTRY_ADDED"])), outcomes_of(spark, ("/a", 1, "missing")))
    assert rows(ledger.open(*KEY)) == [("/a", 1, "missing", 2), ("/c", 2, "missing", 1)]
    ledger.record(*KEY, ledger.open(*KEY), outcomes_of(spark, ("/a", 1, None), ("/c", 2, "missing")))
    assert rows(ledger.open(*KEY)) == [("/c", 2, "missing", 2)]


def test_odd_rows(spark):
    none = spark.createDataFrame([], FAILURE_SCHEMA)
    feed = feed_of(spark, (None, 1, None), ("/a", None, None), ("/a", None, ["x"]), ("/a", 3, ["x", "y"]), ("/a", 3, ["y"]))
    outcomes = outcomes_of(spark, (None, 1, "missing"), ("/a", None, "missing"), ("/a", None, "missing"), ("/a", 3, "unreadable"))
    found = merged(none, feed, outcomes)
    assert sorted((r.path, r.snapshot or 0, sorted(r.change_types), r.attempts) for r in found.collect()) == [("/a", 0, ["x"], 1), ("/a", 3, ["x", "y"], 1)]
    assert merged(found, feed, outcomes_of(spark, ("/a", None, None), ("/a", 3, None))).count() == 0


def test_old_tables_go(spark, ledger, tmp_path):
    for _ in range(6):
        ledger.record(*KEY, feed_of(spark, ("/a", 1, None)), outcomes_of(spark, ("/a", 1, "missing")))
    assert rows(ledger.open(*KEY)) == [("/a", 1, "missing", 6)]
    assert len(list((tmp_path / "ledger").glob("key=*/open-*"))) == 3


def test_a_run_brings_failures_back(spark, tmp_path, make_index, ledger):
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    store = tmp_path / "files" / "ifs"
    store.mkdir(parents=True)
    (store / "a").write_bytes(b"\xff\xfe")
    (store / "b").write_text("fine")
    entries = [(n, f"/ifs/{name}", "regular", n, ["ENTRY_ADDED"]) for n, name in enumerate("abc")]

    def load(rows):
        loader = sf.ContentLoader(make_index(rows), log, "/ifs", root=str(tmp_path / "files"), failures=ledger)
        texts = sorted(r.page_content for r in loader.load().collect())
        loader.commit()
        return texts, {r.path: r.error for r in loader.outcomes().collect()}

    assert load(entries) == (["fine"], {"/ifs/a": "unreadable", "/ifs/b": None, "/ifs/c": "missing"})
    (store / "a").write_text("mended")
    assert load(entries) == (["mended"], {"/ifs/a": None, "/ifs/c": "missing"})
    (store / "c").write_text("late")
    (store / "d").write_text("new")
    assert load([*entries, (3, "/ifs/d", "regular", 3, None)])[0] == ["late", "new"]
    assert load([*entries, (4, "/ifs/e", "directory", 4, None)]) == ([], {})


def test_a_run_that_came_no_further_is_repeated(spark, tmp_path, make_index, ledger):
    """The ledger was written and the checkpoint was not: the failed file comes once, from the range."""
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    index = make_index([(1, "/ifs/a", "regular", 1, ["ENTRY_ADDED"])])
    run = sf.IncrementalRun(index, log, sf.FolderScope("/ifs"), failures=ledger)
    with pytest.raises(ValueError, match="report"):
        run.commit()
    ledger.record(*run.key, run.changes(), outcomes_of(spark, ("/ifs/a", 1, "missing")))
    again = sf.IncrementalRun(index, log, sf.FolderScope("/ifs"), failures=ledger)
    assert again.changes().count() == 1
    again.report(outcomes_of(spark, ("/ifs/a", 1, None)))
    assert again.commit() and rows(ledger.open(*run.key)) == []
    assert sf.IncrementalRun(index, log, sf.FolderScope("/ifs"), failures=ledger).changes().count() == 0


def test_a_block_commits_what_was_reported(spark, tmp_path, make_index, ledger):
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    index = make_index([(1, "/ifs/a", "regular", 1, None)])
    with sf.IncrementalRun(index, log, sf.FolderScope("/ifs"), failures=ledger) as run:
        run.report(sf.process_files(run.changes(), lambda path: False))
    assert rows(ledger.open(*run.key)) == [("/ifs/a", 1, "failed", 1)]
    forced = sf.IncrementalRun(index, log, sf.FolderScope("/ifs"), force_scan=True, failures=ledger)
    assert forced.changes().count() == 1
