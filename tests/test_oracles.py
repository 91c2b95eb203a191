"""Every registered query against its SQL, and the driver's contract."""

import duckdb
import pytest

import __spark_entry__ as contract
from citemill.plans.oracle import ORACLE as SQL
from citemill.plans.queries import QUERIES
from tools.check_oracles import TABLES, rows


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, small, name):
    frame = QUERIES[name](spark, small)
    result = db.execute(SQL[name])
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    types = sorted((f.name, kinds[f.dataType.simpleString()]) for f in frame.schema)
    assert types == sorted((c[0], str(c[1])) for c in result.description)
    got = rows(frame.toPandas())
    assert got == rows(result.df()) and got


def test_flagship(spark):
    found = contract.entry(spark)
    assert found.columns == contract.entry(spark).columns
    assert found.count() == 40 and found.filter("answer is null").count() == 40
    assert found.filter("confidence_level is null or num_sources <> 3").isEmpty()
