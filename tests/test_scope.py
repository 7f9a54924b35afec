import pytest

import snapfeed as sf
from snapfeed.functions import normalise_folder
from snapfeed.sources.datasets import check_predicate

PATHS = [
    "/ifs/data",
    "/ifs/data/a.txt",
    "/ifs/data2/a.txt",
    "/ifs/backup/ifs/data/a.txt",
    "/ifs/data/ifs/data/a.txt",
    "/ifs/dat/a.txt",
    "/IFS/DATA/a.txt",
]


@pytest.mark.parametrize(
    ("mode", "expected"),
    [("prefix", {1, 2, 3, 5}), ("subtree", {1, 2, 5}), ("phrase", {1, 2, 3, 4, 5})],
)
def test_folder_modes(spark, mode, expected):
    paths = spark.createDataFrame(list(enumerate(PATHS, 1)), "lin long, path string")
    found = sf.under_folder(paths, "/ifs/data", mode).collect()
    assert {row.lin for row in found} == expected


@pytest.mark.parametrize("mode", ["prefix", "subtree", "phrase"])
def test_wildcards_in_a_folder_are_plain_characters(spark, mode):
    paths = spark.createDataFrame(
        [("/ifs/a_b%/x",), ("/ifs/aXbYY/x",), ("/ifs/a_bZ/x",)], "path string"
    )
    assert [r.path for r in sf.under_folder(paths, "/ifs/a_b%", mode).collect()] == ["/ifs/a_b%/x"]


@pytest.mark.parametrize(
    "spelling", ["/ifs/data", "/ifs/data/", "/ifs/data//", "/ifs/data/ ", "/ifs/data /\t/ "]
)
def test_spellings_of_a_folder_are_one_scope(spelling):
    assert sf.FolderScope(spelling) == sf.FolderScope("/ifs/data")
    assert sf.FolderScope(spelling).key == "/ifs/data"


def test_folder_root():
    assert normalise_folder("/ifsx/") == "/ifsx"
    assert normalise_folder("/mnt/a/", root="/mnt") == "/mnt/a"
    with pytest.raises(ValueError):
        normalise_folder("/data")
    with pytest.raises(ValueError):
        sf.FolderScope("/ifs", "glob")


def test_exactly_one_kind_of_scope(spark):
    definitions = spark.createDataFrame([("d", "lin > 1")], "dataset string, predicate string")
    with pytest.raises(ValueError):
        sf.make_scope()
    with pytest.raises(ValueError):
        sf.make_scope("/ifs", "d", definitions)
    with pytest.raises(ValueError):
        sf.make_scope(dataset_name="d")
    assert sf.make_scope("/ifs/a/").key == "/ifs/a"
    assert sf.make_scope(dataset_name="d", dataset_definitions=definitions).key == "d"


def test_unknown_and_ambiguous_datasets(spark):
    definitions = spark.createDataFrame(
        [("twice", "lin > 1"), ("twice", "lin > 2"), ("same", "lin > 1"), ("same", "lin > 1")],
        "dataset string, predicate string",
    )
    with pytest.raises(ValueError, match="not found"):
        sf.dataset_predicate(definitions, "none")
    with pytest.raises(ValueError, match="more than one"):
        sf.dataset_predicate(definitions, "twice")
    assert sf.dataset_predicate(definitions, "same") == "lin > 1"


@pytest.mark.parametrize(
    "predicate",
    [
        "",
        "lin in (select 1)",
        "exists ( /* x */ SELECT 1)",
        "lin = (with t as (select 1) select * from t)",
        "lin in (values 1)",
        "lin in ((table t))",
        "java_method('java.lang.System', 'getenv') is not null",
        "reflect('java.lang.System', 'exit', 1) = ''",
    ],
)
def test_predicates_that_are_no_column_condition(predicate):
    with pytest.raises(ValueError):
        check_predicate(predicate)


@pytest.mark.parametrize(
    "predicate",
    [
        "path like '%(select)%'",
        "path = '(select 1)' and `file_type` = \"(select\"",
        "size(map('a', 1)) = (map('a', 1))['a']",
        "trim(both ' ' from path) <> ''",
        "(selected or lin > 3)",
    ],
)
def test_predicates_that_only_look_like_queries(predicate):
    assert check_predicate(predicate) == predicate


@pytest.mark.parametrize("predicate", ["rand() < 0.5", "s2 > 1 AND uuid () > 'a'", "path < string(now())"])
def test_predicates_that_change_from_row_to_row(predicate):
    with pytest.raises(ValueError, match="must not change"):
        check_predicate(predicate)
    assert check_predicate("path like '%rand()%' and random_id > 1")


def test_dataset_is_joined_to_the_other_conditions_as_a_whole(make_index):
    index = make_index(
        [
            (1, "/ifs/a", "regular", 1, []),
            (2, "/ifs/b", "directory", 1, []),
            (3, "/ifs/c", "regular", 9, []),
        ]
    )
    scope = sf.DatasetScope("either", "lin = 2 or lin = 1 or lin = 3")
    feed = sf.directory_changes(index, scope, 0, 5)
    assert [row.path for row in feed.collect()] == ["/ifs/a"]


def test_modes_have_checkpoints_of_their_own():
    keys = {sf.FolderScope("/ifs/data", mode=mode).key for mode in ("prefix", "subtree", "phrase")}
    assert len(keys) == 3 and "/ifs/data" in keys


@pytest.mark.parametrize(
    "predicate",
    [
        "current_date > date'2020-01-01'",
        "unix_timestamp() % 2 = 0",
        "input_file_name() like '%a%'",
        "_metadata.file_path like '%a%'",
        "_metadata is not null",
        "path < current_timestamp",
        "current_user() = 'a'",
        "spark_partition_id() = 1",
        "monotonically_increasing_id() > 2",
        "lin",
        "path",
        "sum(lin) > 1",
        "row_number() over (order by lin) > 1",
        "explode(change_types) = 'a'",
        "lin > ",
        "nowhere.column = 1",
        "no_such_function(lin)",
        "try_reflect('java.lang.Math', 'random') > '1'",
    ],
)
def test_predicates_that_follow_the_clock_the_file_or_nothing(spark, predicate):
    with pytest.raises(ValueError):
        check_predicate(predicate)


@pytest.mark.parametrize("predicate", ["s2 > unix_timestamp('2020-01-01')", "array_contains(change_types, 'a') or owner = 'x'"])
def test_steady_predicates(spark, predicate):
    assert check_predicate(predicate) == predicate
