from random import Random

import pytest

import snapfeed as sf
from snapfeed.sources.phrases import PAIRS, can_prune, files_with, path_pairs

PATHS = "path string, file string"


def entry(lin, path, snapshot=1):
    return lin, path, "regular", snapshot, ["ENTRY_ADDED"]


@pytest.fixture
def table(spark, tmp_path):
    return sf.IndexTable(spark, str(tmp_path / "index"))


def test_pairs_of_a_path(spark):
    rows = [("/a/b/x", "f"), ("/a/b/y", "f"), ("/a/b/y", "f"), (None, "f"), ("", "f"), ("none", "f"), ("s:/c", "g")]
    pairs = path_pairs(spark.createDataFrame(rows, PATHS))
    assert pairs.schema.simpleString() == spark.createDataFrame([], PAIRS).schema.simpleString()
    assert sorted(map(tuple, pairs.collect())) == [
        (1, "", "a", "a", True, "f"),
        (1, "s:", "c", "c", False, "g"),
        (2, "a", "b", "b", True, "f"),
        (3, "b", "x", "y", False, "f"),
    ]


def test_no_file_with_a_phrase_is_left_out(spark):
    """Random paths of few names, against plain text search; a file of one path is judged exactly."""
    random = Random(5)
    names = ["", "a", "ab", "abc", "b", "ä", "a%", "_"]

    def path(n):
        return random.choice(["", "/", "s:"]) + "/".join(random.choice(names) for _ in range(random.randint(1, n)))

    rows = [(path(6), f"one{n}") for n in range(300)]
    rows += [(path(6), f"many{n % 20}") for n in range(200)]
    pairs = path_pairs(spark.createDataFrame(rows, PATHS)).cache()
    for _ in range(25):
        phrase = "/" + "/".join(random.choice(names) for _ in range(random.randint(1, 4)))
        phrase = phrase.rstrip("/") or "/a"
        found = {row.file for row in files_with(pairs, phrase).collect()}
        needed = {file for text, file in rows if phrase in text}
        assert needed <= found, phrase
        assert {f for f in found if f.startswith("one")} == {f for f in needed if f.startswith("one")}, phrase
    pairs.unpersist()


def test_files_without_the_phrase_are_not_opened(spark, table, make_index, tmp_path):
    """A file per folder: reads and runs open those alone that hold the phrase, in the middle of a path too."""
    folders = ["/ifs/data", "/ifs/backup/ifs/data", "/ifs/dat", "/ifs/data2", "/ifs/x"]
    for folder in folders:
        table.append(make_index([entry(n, f"{folder}/{n}.txt") for n in range(3)]), partitions=1)
    assert len(table.files(phrase="/ifs/data")) == 5
    assert table.index_phrases() == 5 and table.index_phrases() == 0
    assert len(table.files(phrase="/ifs/data")) == 3
    assert len(table.files(phrase="/ifs/data/1.t")) == 2  # names between 0.txt and 2.txt
    assert len(table.files(phrase="/ifs/data2/9")) == 0 == table.read(phrase="/ifs/data2/9").count()
    assert len(table.files(phrase="/data/ifs")) == 0 and len(table.files(phrase="/backup/ifs/d")) == 1
    scope = sf.FolderScope("/ifs/data", "phrase")
    run = sf.IncrementalRun(table, sf.CheckpointLog(spark, str(tmp_path / "log")), scope)
    assert len(run._index(run.low).inputFiles()) == 3
    assert sorted(row.path for row in run.changes().collect()) == sorted(
        f"{folder}/{n}.txt" for folder in folders if "/ifs/data" in folder for n in range(3)
    )
    # the snapshot range still counts
    assert table.files(low=1, phrase="/ifs/data") == []
    table.check()


def test_writes_without_an_index_are_read(table, make_index):
    table.append(make_index([entry(1, "/ifs/a/x")]))
    table.index_phrases()
    old = table.frozen()
    table.append(make_index([entry(2, "/ifs/b/x"), (3, None, "regular", 1, None)]))
    assert len(table.files(phrase="/ifs/b")) == 1 and len(old.files(phrase="/ifs/b")) == 0
    assert len(table.files(phrase="/ifs/zzz")) == 1  # not gone over yet
    assert table.index_phrases() == 1 and table.files(phrase="/ifs/zzz") == []
    assert sf.under_folder(table.read(phrase="/ifs/b"), "/ifs/b", "phrase").count() == 1


def test_empty_tables_and_other_roots(table, make_index):
    assert table.index_phrases() == 0 and table.files(phrase="/ifs") == []
    table.append(make_index([]))
    assert table.index_phrases() == 1 and table.read(phrase="/ifs").count() == 0
    assert not can_prune("data") and not can_prune("") and can_prune("/ifs")
    table.append(make_index([entry(1, "s3:/some data/x")]))
    table.index_phrases()
    assert len(table.files(phrase="me data/x")) == 1 and len(table.files(phrase="/some data/x")) == 1


def test_adopted_files_in_folders_of_any_name(spark, table, make_index):
    for name, path in (("day=1/x.(1)", "/ifs/a/1"), ("day=2/x+1", "/ifs/b/1")):
        make_index([entry(1, path)]).coalesce(1).write.parquet(f"{table.path}/{name}")
    table.adopt()
    assert table.index_phrases() == 1
    assert [f.split("/")[0] for f in table.files(phrase="/ifs/b")] == ["day=2"]
    assert [row.path for row in table.read(phrase="/ifs/b").collect()] == ["/ifs/b/1"]


def test_literals_reach_the_scan(spark, table, make_index, plan_of):
    table.append(make_index([entry(1, "/ifs/a/x")]))
    table.index_phrases()
    name = table.segments()[0]["phrases"]
    pairs = spark.read.schema(PAIRS).parquet(f"{table.path}/_manifest/phrases/{name}")
    plan = plan_of(files_with(pairs, "/ifs/a/x"))
    assert "EqualTo(parent,ifs)" in plan and "EqualTo(low,a)" in plan and "GreaterThanOrEqual(high,x)" in plan
    assert "Python" not in plan
