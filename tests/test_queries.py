"""Every query of the feed against its SQL, over whole tables."""

from pathlib import Path

import pytest

import __spark_entry__
from checks.compare import compare
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert compare(spark, str(SF_DIR), name) == ""


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= __spark_entry__.queries().items()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
