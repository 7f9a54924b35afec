"""The driver's module without what only the optional part needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()) >= len(entry.QUERIES) > 50, any(name.startswith("op") and name[2].isdigit() for name in entry.queries()))
"""


def run(name):
    return subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("name", ["regex", "zstandard", "snapfeed.llm"])
def test_queries_without_a_library_of_the_optional_part(name):
    got = run(name)
    assert got.returncode == 0, got.stderr
    assert got.stdout.split()[0] == "True"
    if name == "snapfeed.llm":
        assert got.stdout.split()[1] == "False" and "left out" not in got.stderr


def test_a_missing_module_of_the_rest_is_an_error():
    assert run("snapfeed.sources.files").returncode != 0
