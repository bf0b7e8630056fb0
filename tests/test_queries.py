"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from millrace import mail_queries, queries, text_queries  # noqa: F401  they register their queries in queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return connection


def plain(frame):
    columns = sorted(frame.columns)
    cell = lambda v: None if pd.isna(v) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return columns, sorted((tuple(cell(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, duck, name):
    assert plain(queries.QUERIES[name](spark, DIR).toPandas()) == plain(duck.execute(queries.SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_rows_without_sql(spark, name):
    assert queries.QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
