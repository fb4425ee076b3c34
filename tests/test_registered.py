"""The registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
from checks import oracle
from checks.compare import TABLES, _normal

SF_DIR = "/root/testdata/sf0.001"
NAMES = list(oracle.all_sql())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


def test_every_sql_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = registered.queries()[name](spark, SF_DIR)
    found = duck.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    ours = _normal([tuple(r) for r in df.collect()], df.columns)
    assert ours == _normal(found.fetchall(), columns) and ours


def test_entry(spark):
    assert registered.entry(spark).count() == 4
