"""Every registered query against the SQL that it is said to equal, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from wordgrove.plans.catalogue import oracle_sql, queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the given tables aren't here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def shown(value):
    if value is None or value != value:
        return "null"
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    frame = queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    ours = sorted(tuple(shown(row[c]) for c in columns) for row in frame.collect())
    found = database.execute(oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert columns == sorted(names)
    theirs = sorted(tuple(shown(row[names.index(c)]) for c in columns) for row in found.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, DATA).limit(5).count() > 0
