"""The registered queries, against SQL where there is some, and the pipeline."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from snapfeed.llm.oracles import ORACLES
from snapfeed.llm.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


def test_registered():
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    database = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        database.execute(f"create view {file.stem} as select * from '{file}'")
    wanted = database.execute(ORACLES[name])
    columns = [column[0] for column in wanted.description]
    rows = QUERIES[name](spark, str(SF_DIR)).select(*columns).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, wanted.fetchall()))


def test_pipeline(spark):
    docs = corpus_pipeline.table(spark, str(SF_DIR), "documents")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, str(SF_DIR)), "test")
        assert docs.columns[: len(columns)] == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.where("copies < 1 or taken <> copies * size").count() == 0
