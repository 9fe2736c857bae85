"""Every registered query against its check SQL in DuckDB, value by value."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry
from scrubline.checks.oracle import oracle_sql
from scrubline.checks.queries import QUERIES

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
SCALES = os.environ.get("CHECK_SCALES", "sf0.001,sf0.01").split(",")
# Types that the two engines name differently.
SAME_TYPE = {"string": "VARCHAR", "int": "INTEGER"}


@pytest.fixture(scope="module", params=SCALES)
def sf_dir(request):
    return f"{TESTDATA}/{request.param}"


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("orders", "customer", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_check_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(oracle_sql()[name])
    described = {column[0]: str(column[1]) for column in result.description}
    assert len(described) == len(result.description)
    columns = sorted(described)
    assert columns == sorted(df.columns)
    assert {c: SAME_TYPE.get(t, t.upper()) for c, t in df.dtypes} == described

    position = {column[0]: i for i, column in enumerate(result.description)}
    expected = Counter(tuple(row[position[c]] for c in columns) for row in result.fetchall())
    found = Counter(tuple(row) for row in df.select([f"`{c}`" for c in columns]).collect())
    assert found.total() > 0
    assert found == expected


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 951
    assert len(df.columns) == 37
