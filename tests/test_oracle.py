"""Every registered query against its SQL on the small driver tables."""

import collections
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from replylens.plans import oracle, queries as registry

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float) and value == int(value):
        value = int(value)
    return str(value)


def bag(rows):
    return collections.Counter(tuple(map(plain, row)) for row in rows)


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    # Queries of the pipeline operators are checked beside these.
    assert set(registry.queries()) <= set(contract.oracle_sql())


def test_entry_returns_daily_rows(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 30
    assert "acceptance_ma7" in rows[0]


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = duck.execute(contract.oracle_sql()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    expected = bag(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert bag(result.select(*columns).collect()) == expected
    assert expected


@pytest.mark.parametrize("name", ["cluster_reasons"])
def test_model_query_runs(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0
