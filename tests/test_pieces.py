import random

import pytest

import snapfeed as sf
from snapfeed.sources.files import PIECE_COLUMNS

SCHEMA = (
    "path string, snapshot long, change_types array<string>, "
    "piece_no int, first_line long, more boolean, content string, error string"
)


def cut(text, borders):
    edges = [0, *sorted(borders), len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]


@pytest.fixture(scope="module")
def files():
    """Texts, each cut at places of any kind: within words, lines and runs of blanks."""
    draw = random.Random(11)
    out = []
    for n in range(60):
        words = ["".join(draw.choices("abé,", k=draw.randint(1, 9))) for _ in range(draw.randint(0, 80))]
        text = "".join(w + draw.choice([" ", "  ", "\n", "\n\n", "\t", " \r\n", "."]) for w in words)
        text = draw.choice(["", "\n", "  "]) + text + draw.choice(["", "end", "\n"])
        count = draw.choice([0, 1, 3, 12]) if text else 0
        out.append((f"/ifs/{n}", n, ["ENTRY_ADDED"] if n % 3 else None, cut(text, draw.choices(range(1, len(text) + 1), k=count) if count else [])))
    out.append(("/ifs/long", 1, [], cut("x" * 900 + " y", range(50, 900, 50))))
    out.append(("/ifs/blank", 1, [], [" \n", "\t ", "\n"]))
    return out


@pytest.fixture(scope="module")
def read(spark, files):
    rows = []
    for path, snapshot, kinds, pieces in files:
        lines = 0
        for number, piece in enumerate(pieces):
            rows.append((path, snapshot, kinds, number, lines, number < len(pieces) - 1, piece, None))
            lines += piece.count("\n")
    rows += [r for r in rows if r[0] in ("/ifs/3", "/ifs/4", "/ifs/long")]  # delivered twice
    rows += [("/ifs/torn", 1, [], 0, 0, True, "one\ntwo ", None), ("/ifs/torn", 1, [], 1, 1, False, None, "unreadable")]
    rows += [("/ifs/gone", 1, [], 0, 0, False, None, "missing"), (None, None, None, 0, 0, True, "a b", None), (None, None, None, 1, 0, False, "c\nd", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def whole(spark, files):
    texts = [(path, snapshot, kinds, "".join(pieces)) for path, snapshot, kinds, pieces in files]
    texts += [t for t in texts if t[0] in ("/ifs/3", "/ifs/4", "/ifs/long")] + [(None, None, None, "a bc\nd")]
    return spark.createDataFrame(texts, "path string, snapshot long, change_types array<string>, content string")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(("size", "overlap", "chars"), [(300, 10, 5000), (7, 3, 20), (1, 0, 4), (5, 4, 1000)])
def test_chunks_are_those_of_whole_files(read, whole, size, overlap, chars):
    found = sf.chunk_pieces(read, size, overlap, chars)
    wanted = sf.chunk_words(whole, size, overlap, chars, text="content")
    assert found.columns == wanted.columns
    assert rows(found) == rows(wanted)


def test_elements_and_documents_are_those_of_whole_files(read, whole):
    documents = sf.document_rows(whole)
    assert rows(sf.whole_documents(read)) == rows(documents)
    assert rows(sf.element_pieces(read)) == rows(sf.split_elements(documents))


def test_sizes_are_checked(read):
    with pytest.raises(ValueError):
        sf.chunk_pieces(read, 5, 5)


def test_nothing_read(spark):
    none = spark.createDataFrame([], SCHEMA)
    for found in (sf.chunk_pieces(none), sf.element_pieces(none), sf.whole_documents(none)):
        assert found.count() == 0


def test_files_in_one_piece_are_not_shuffled(spark, read, plan_of, tmp_path):
    read.write.parquet(str(tmp_path / "read"))
    plan = plan_of(sf.chunk_pieces(spark.read.schema(read.schema).parquet(str(tmp_path / "read"))))
    tree = plan[: plan.index("\n\n")].splitlines()
    first = [line for line in tree if line.startswith("   :")]  # the first of the union's two sides
    assert any("Generate" in line for line in first) and not any("Exchange" in line for line in first)


def test_the_loader_gives_a_document_per_file(spark, tmp_path, make_index, monkeypatch):
    text = "".join(f"line {n} of many\n" for n in range(400))
    (tmp_path / "ifs").mkdir()
    (tmp_path / "ifs" / "a").write_text(text)
    index = make_index([(1, "/ifs/a", "regular", 1, ["ENTRY_ADDED"])])
    feed = sf.directory_changes(index, sf.FolderScope("/ifs"), -1, 1)
    opened = sf.open_changed_files(feed, str(tmp_path), piece_bytes=64)
    assert opened.count() > 50 and set(PIECE_COLUMNS) <= set(opened.columns)
    assert [row.page_content for row in sf.whole_documents(opened).collect()] == [text]
    log = sf.CheckpointLog(spark, str(tmp_path / "log"))
    loader = sf.ContentLoader(index, log, "/ifs", root=str(tmp_path), mode="elements")
    assert loader.load().count() == 400
