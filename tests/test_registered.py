"""Every registered query against its SQL, at the smallest scale."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from registered import all_queries
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    registry = all_queries()
    assert registry.queries.keys() == registry.sql.keys()
    assert registry.queries.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(all_queries().queries))
def test_query_agrees_with_sql(spark, duck, name):
    rows, problems = compare(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name])
    assert not problems
    assert rows > 0


@pytest.mark.parametrize("missing", ["tiktoken", "layerwright.llm", "corpus_pipeline"])
def test_the_other_queries_do_without_llm(missing):
    """A package that cannot be imported takes the queries that need it away, and no others."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as c; print(len(c.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(contract.__file__).parent, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(all_queries().queries))], out.stderr
    assert "not offered" in out.stderr


def test_entry(spark):
    assert contract.entry(spark).count() > 0
