"""Every registered query against its SQL, run by DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__
from tillmark.plans import oracle, registry
from tillmark.sources.star import COLUMNS

SF = "/root/testdata/sf0.001"
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in COLUMNS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    described = database.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert sorted(c[0] for c in described) == columns
    types = {c[0]: str(c[1]) for c in described}
    assert {c: TYPES.get(t, t.upper()) for c, t in df.dtypes} == types
    expected = database.execute(f"SELECT {quoted} FROM ({ORACLE[name]})").fetchall()
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_sorted_reports_come_in_their_order(spark):
    report = QUERIES["report_time_analysis"](spark, SF).collect()
    keys = [(r.day_name, r.order_hour, r.location_name) for r in report]
    assert keys == sorted(keys)
    revenue = [r.total_revenue for r in QUERIES["report_menu_performance"](spark, SF).collect()]
    assert revenue == sorted(revenue, reverse=True)


def test_entry_point(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[:4] == ["location_id", "location_name", "order_year", "order_month"]
    assert df.count() > 0
