"""Every registered query equals its DuckDB oracle on the driver tables."""

import pytest

from wattline.registry import ORACLES, QUERIES
from wattline.testing import compare, duckdb_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name not in ORACLES:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
