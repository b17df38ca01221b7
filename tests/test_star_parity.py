"""Every conformed star table agrees with the DuckDB star twin."""

import pytest

from confluo.plans.star import Conformer
from confluo.sources.binding import Landed
from sqlcheck.compose import with_ctes
from sqlcheck.star import STAR_CTES, STAR_TABLES
from tests.compare import compare


@pytest.fixture(scope="module")
def conformer(spark, sf_small):
    return Conformer(Landed(spark, sf_small))


@pytest.mark.parametrize("name", STAR_TABLES)
def test_star_table_matches_duckdb(conformer, sf_small, name):
    ok, msg = compare(getattr(conformer, name), with_ctes(f"SELECT * FROM {name}", STAR_CTES), sf_small)
    assert ok, f"{name}: {msg}"
