"""Every registered query against its SQL in DuckDB on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from checks import ORACLES, QUERIES
from checks.feeds import TABLES
from verify import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name])
    assert result.startswith("ok") and "types" not in result, result


def test_entry(spark):
    assert entry(spark).count() > 0
