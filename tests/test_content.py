import sys
import tracemalloc
from pathlib import Path

import pandas as pd
import pytest

import snapfeed as sf
from snapfeed.sources.files import BATCH_BYTES, HEAD_BYTES, RETRY_DELAYS, retried

FEED = "path string, snapshot bigint, change_types array<string>"


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(
        [
            ("/ifs/a", 1, ["ENTRY_ADDED"]),
            ("/ifs/b", 2, []),
            ("/ifs/gone", 3, ["ENTRY_DELETED"]),
            ("/ifs/bad", 3, ["ENTRY_ADDED"]),
            ("/ifs/a", 5, ["ENTRY_ADDED"]),
        ],
        FEED,
    )


@pytest.fixture(scope="module")
def content(spark):
    return spark.createDataFrame(
        [
            ("/ifs/a", "Head\n\n  1. first \n- second\r\nA sentence."),
            ("/ifs/b", ""),
            ("/ifs/bad", None),
            ("/ifs/unchanged", "x"),
        ],
        "path string, content string",
    )


def test_documents(feed, content):
    found = sorted(
        (r.metadata.source, r.metadata.snapshot, r.page_content)
        for r in sf.load_documents(feed, content).collect()
    )
    text = "Head\n\n  1. first \n- second\r\nA sentence."
    assert found == [("/ifs/a", 1, text), ("/ifs/a", 5, text), ("/ifs/b", 2, "")]


def test_elements(feed, content):
    elements = sf.load_elements(feed.where("snapshot = 1"), content).collect()
    assert [
        (r.metadata.element_no, r.metadata.category, r.page_content)
        for r in sorted(elements, key=lambda r: r.metadata.element_no)
    ] == [
        (0, "Title", "Head"),
        (2, "ListItem", "1. first"),
        (3, "ListItem", "- second"),
        (4, "NarrativeText", "A sentence."),
    ]
    assert elements[0].metadata.change_types == ["ENTRY_ADDED"]


def test_outcomes_and_summary(feed, content):
    found = sf.outcomes(feed, content)
    assert sorted((r.path, r.snapshot, r.ok, r.error) for r in found.collect()) == [
        ("/ifs/a", 1, True, None),
        ("/ifs/a", 5, True, None),
        ("/ifs/b", 2, True, None),
        ("/ifs/bad", 3, False, "unreadable"),
        ("/ifs/gone", 3, False, "missing"),
    ]
    assert sf.run_summary(found).first().asDict() == {"files": 5, "success": 3, "errors": 2}
    assert sf.run_summary(found.where("false")).first().asDict() == {
        "files": 0,
        "success": 0,
        "errors": 0,
    }


def test_missing_and_present(feed, content):
    assert [r.path for r in sf.missing_files(feed, content).collect()] == ["/ifs/gone"]
    present = sf.present_files(feed, content)
    assert sorted(r.path for r in present.collect()) == ["/ifs/a", "/ifs/a", "/ifs/b", "/ifs/bad"]
    assert present.columns == feed.columns


def test_one_outcome_per_file_even_if_content_repeats(spark, feed):
    twice = spark.createDataFrame(
        [("/ifs/a", None), ("/ifs/a", "x"), ("/ifs/a", "y")], "path string, content string"
    )
    found = sf.outcomes(feed.where("snapshot = 1"), twice).collect()
    assert [(r.ok, r.error) for r in found] == [(True, None)]


@pytest.fixture
def tree(tmp_path):
    folder = tmp_path / "root dir" / "ifs"
    folder.mkdir(parents=True)
    (folder / "a").write_bytes("one\r\ntwo é".encode())
    (folder / "b").write_bytes(b"")
    (folder / "bad").write_bytes(b"\xff\xfe\x00")
    (folder / "a b%20c").write_bytes(b"blank")
    (folder / "long.gz").write_bytes(b"x" * 21)
    (folder / "sub").mkdir()
    (folder / "sub" / "deep").write_bytes(b"deep")
    return str(tmp_path / "root dir")


@pytest.mark.parametrize("batch_bytes", [1, 1 << 20])
@pytest.mark.parametrize("scheme", [False, True])
def test_files_opened_by_the_feed(spark, feed, tree, batch_bytes, scheme):
    more = feed.union(
        spark.createDataFrame(
            [("/ifs/sub", 4, []), ("/ifs/a b%20c", 4, []), ("/ifs/long.gz", 4, [])], FEED
        )
    ).coalesce(1)
    root = Path(tree).as_uri() if scheme else tree
    opened = sf.open_changed_files(more, root, batch_bytes=batch_bytes)
    assert sorted((r.path, r.snapshot, r.content, r.error) for r in opened.collect()) == [
        ("/ifs/a", 1, "one\r\ntwo é", None),
        ("/ifs/a", 5, "one\r\ntwo é", None),
        ("/ifs/a b%20c", 4, "blank", None),
        ("/ifs/b", 2, "", None),
        ("/ifs/bad", 3, None, "unreadable"),
        ("/ifs/gone", 3, None, "missing"),
        ("/ifs/long.gz", 4, "x" * 21, None),
        ("/ifs/sub", 4, None, "unreadable"),
    ]
    assert sf.document_rows(opened).count() == 5


LINES = "".join(f"line {n} é日\n" * (n % 3) + "\n" * (n % 2) for n in range(60)) + "end"


@pytest.mark.parametrize("piece_bytes", [1, 7, 64, 10_000])
def test_files_in_pieces(spark, tmp_path, piece_bytes):
    (tmp_path / "lines").write_bytes(b"\xef\xbb\xbf" + LINES.encode())
    (tmp_path / "late").write_bytes(b"good\n" * 30 + b"\xff")
    feed = spark.createDataFrame([("/lines", 1, []), ("/late", 1, [])], FEED)
    opened = sf.open_changed_files(feed, str(tmp_path), piece_bytes=piece_bytes).collect()
    pieces = sorted((r.piece_no, r.first_line, r.content, r.more) for r in opened if r.path == "/lines")
    assert "".join(piece[2] for piece in pieces) == LINES
    assert [piece[0] for piece in pieces] == list(range(len(pieces)))
    assert [piece[3] for piece in pieces] == [True] * (len(pieces) - 1) + [False]
    assert (len(pieces) == 1) == (piece_bytes == 10_000)
    opened = spark.createDataFrame(opened, "path string, snapshot bigint, change_types array<string>, "
                                   "piece_no int, first_line bigint, more boolean, content string, error string")
    found = {(r.path, r.error) for r in sf.outcome_rows(opened).collect()}
    assert sf.outcome_rows(opened).count() == 2 and found == {("/lines", None), ("/late", "unreadable")}
    if piece_bytes >= 64:
        elements = sf.split_elements(sf.document_rows(opened.where("path = '/lines'"))).collect()
        assert sorted((r.metadata.element_no, r.page_content) for r in elements) == [
            (n, line) for n, line in enumerate(LINES.split("\n")) if line
        ]


@pytest.fixture
def peak_of(spark, tmp_path, monkeypatch):
    """The most memory that a reader of so many files takes; ``look`` sees the texts of each frame."""
    readers = []

    def keep(frame, function, schema):
        readers.append(function)
        return map_in_pandas(frame, function, schema)

    feed = spark.createDataFrame([], FEED)
    map_in_pandas = type(feed).mapInPandas
    monkeypatch.setattr(type(feed), "mapInPandas", keep)
    sf.open_changed_files(feed, str(tmp_path), partitions=1)

    def run(files, look):
        batch = pd.DataFrame({"path": [f"/{n}" for n in range(files)], "snapshot": 1, "change_types": None})
        tracemalloc.start()
        for frame in readers[0](iter([batch])):
            look(list(frame["content"]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak

    return run


def test_memory_of_a_reader_does_not_follow_its_files(tmp_path, peak_of):
    text = "日" * (1 << 19)
    for n in range(64):
        (tmp_path / str(n)).write_text(text, encoding="utf-8")
    read = []

    def look(texts):
        assert sum(map(sys.getsizeof, texts)) < BATCH_BYTES + sys.getsizeof(text)
        assert set(texts) == {text}
        read.append(len(texts))

    few, many = peak_of(16, look), peak_of(64, look)
    assert many < 1.3 * few
    assert sum(read) == 80


def test_small_files_take_no_more_than_they_hold(tmp_path, peak_of):
    for n in range(50):
        (tmp_path / str(n)).write_text("x" * n)
    read = []
    assert peak_of(50, read.extend) < HEAD_BYTES // 2
    assert read == ["x" * n for n in range(50)]


def test_each_file_is_opened_once(spark, tmp_path, make_index):
    (tmp_path / "ifs").mkdir()
    (tmp_path / "ifs" / "once").write_text("text")
    index = make_index([(1, "/ifs/once", "regular", 1, ["ENTRY_ADDED"])])
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    loader = sf.ContentLoader(index, log, "/ifs", root=str(tmp_path))
    with pytest.raises(ValueError):
        loader.commit()
    documents = loader.load()
    (tmp_path / "ifs" / "once").write_bytes(b"\xff")
    assert [r.page_content for r in documents.collect()] == ["text"]
    assert [r.ok for r in loader.outcomes().collect()] == [True]
    assert loader.commit()


def test_a_failing_store_commits_nothing(spark, tmp_path, monkeypatch):
    waits = []
    monkeypatch.setattr("time.sleep", waits.append)

    def fail():
        raise OSError("throttled")

    with pytest.raises(OSError, match="throttled"):
        retried(fail, lambda error: False)
    assert waits == sorted(waits) and len(waits) == len(RETRY_DELAYS)
    waits.clear()
    with pytest.raises(OSError):
        retried(fail, lambda error: True)
    assert waits == []


def test_loader_opens_files_without_a_content_table(spark, make_index, tree, tmp_path):
    index = make_index(
        [
            (n, f"/ifs/{name}", "regular", n, ["ENTRY_ADDED"])
            for n, name in enumerate(["a", "bad", "gone", "sub/deep"], 1)
        ]
    )
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    loader = sf.ContentLoader(index, log, "/ifs", root=tree, mode="elements", partitions=3)
    with pytest.raises(ValueError):
        loader.outcomes()
    assert sorted(r.page_content for r in loader.load().collect()) == ["deep", "one", "two é"]
    failed = {(r.path, r.error) for r in loader.outcomes().where("not ok").collect()}
    assert failed == {("/ifs/bad", "unreadable"), ("/ifs/gone", "missing")}
    assert loader.commit()
    table = spark.createDataFrame([("/ifs/a", "x")], "path string, content string")
    again = sf.ContentLoader(index, log, "/ifs", app_name="table", content=table)
    assert [r.page_content for r in again.load().collect()] == ["x"]
    assert sf.run_summary(again.outcomes()).first().errors == 3


def test_a_function_of_the_user_per_file(feed):
    def process(path):
        if path == "/ifs/bad":
            raise KeyError(path)
        return path != "/ifs/gone"

    found = sf.process_files(feed, process, partitions=2)
    assert sorted((r.path, r.ok, r.error) for r in found.collect()) == [
        ("/ifs/a", True, None),
        ("/ifs/a", True, None),
        ("/ifs/b", True, None),
        ("/ifs/bad", False, "KeyError: '/ifs/bad'"),
        ("/ifs/gone", False, "failed"),
    ]
    assert sf.run_summary(found).first().errors == 2


def test_the_function_is_called_once_per_file(feed, tmp_path):
    calls = tmp_path / "calls"

    def process(path):
        with open(calls, "a") as file:
            file.write(path + "\n")
        return path != "/ifs/gone"

    found = sf.process_files(feed, process, partitions=2)
    assert sf.run_summary(found).first().errors == 1
    assert found.where("not ok").count() == 1
    assert len(calls.read_text().splitlines()) == feed.count()


def test_outcomes_read_paths_and_nulls_only(spark, feed, content, tmp_path, plan_of):
    content.write.parquet(str(tmp_path / "content"))
    plan = plan_of(sf.outcomes(feed, spark.read.parquet(str(tmp_path / "content"))))
    scans = [block for block in plan.split("\n\n") if "ReadSchema" in block]
    with_text = [scan for scan in scans if "content:string" in scan]
    assert len(scans) == 2 and len(with_text) == 1
    assert "IsNull(content)" in with_text[0]


def test_only_flags_and_paths_are_shuffled(feed, content, plan_of, spark):
    monkey = sf.balanced_join(feed, content.select("path").distinct(), "path", "left_anti")
    assert "content" not in plan_of(monkey.select("path")).split("Exchange")[0]
    plan = plan_of(sf.outcomes(feed, content))
    exchanged = [block for block in plan.split("\n\n") if "hashpartitioning" in block]
    assert exchanged and not any("content" in block.split("Arguments")[0] for block in exchanged)
