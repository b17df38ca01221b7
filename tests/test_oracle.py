"""Every registered query agrees with its DuckDB oracle (sf0.001 by default)."""

import importlib.util
import os

import pytest

from confluo.registry import QUERIES as REGISTERED
from tests.compare import compare, duck

_spec = importlib.util.spec_from_file_location(
    "spark_entry", os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py"))
entry = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry)

# the training-data operators have their own tests
QUERIES = {k: v for k, v in entry.queries().items() if k in REGISTERED}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in REGISTERED}


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_small, con, key):
    df = QUERIES[key](spark, sf_small)
    ok, msg = compare(df, ORACLE[key], sf_small, con)
    assert ok, f"{key}: {msg}"
    assert not msg.startswith("0 rows"), f"{key}: a match of two empty results proves nothing"


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, sf_small, key):
    assert QUERIES[key](spark, sf_small).count() > 0


def test_every_key_has_oracle_or_is_documented():
    rows_only = set(QUERIES) - set(ORACLE)
    assert not rows_only
