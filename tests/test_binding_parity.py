"""Every landed-table binding agrees row for row with its DuckDB twin."""

import pytest

from confluo.sources.binding import Landed
from sqlcheck.binding import LANDED_TABLES
from sqlcheck.compose import with_ctes
from tests.compare import compare, duck


@pytest.mark.parametrize("name", LANDED_TABLES)
def test_binding_matches_duckdb(spark, sf_small, name):
    landed = Landed(spark, sf_small)
    ok, msg = compare(landed.table(name), with_ctes(f"SELECT * FROM {name}"), sf_small)
    assert ok, f"{name}: {msg}"
