"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from tools.check_results import bag
from vacancylake.plans.queries import registered
from vacancylake.plans.queries.analytics import TABLE_NAMES

SF = "/root/testdata/sf0.001"
ENTRIES = registered()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ENTRIES))
def test_same_rows(spark, con, name):
    query, sql = ENTRIES[name]
    df = query(spark, SF)
    ours = bag(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert ours == bag(names, result.fetchall())


def test_every_query_has_sql():
    assert [name for name, (_, sql) in ENTRIES.items() if sql is None] == []


def test_entry_points(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns[0] == "platform"
    assert set(driver.oracle_sql()) <= set(driver.queries())
