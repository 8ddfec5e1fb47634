from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with connect(SMALL) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("missing", ["laborloom.llm", "corpus_pipeline", "tiktoken", "regex", "public_tokenizers"])
def test_the_rest_works_without_the_operators_and_their_needs(missing):
    """In a new interpreter that cannot import the module."""
    code = ("import sys; sys.modules[sys.argv[1]] = None; import __spark_entry__ as e; from checks.queries import QUERIES; "
            "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())")
    done = subprocess.run([sys.executable, "-c", code, missing], cwd=Path(__file__).resolve().parents[1], timeout=120,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry_gives_rows(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, SMALL, name) is None
