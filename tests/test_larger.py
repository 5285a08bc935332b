"""Some queries against their SQL on the next larger tables: those whose rules a small table seldom meets, or that the small test alone has covered."""

from pathlib import Path

import duckdb
import pytest

from tests.test_queries import TABLES, shown
from wordgrove.plans.catalogue import oracle_sql, queries

DATA = "/root/testdata/sf0.01"
STEMS = ("a07", "c07", "c09", "c14", "c20", "e14", "j09", "o03", "e06_turns", "e16_variants", "m08", "t11", "u02_rules", "u02_subtree_sql")
NAMES = sorted(n for n in oracle_sql() if n.startswith(STEMS))

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the given tables aren't here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, database, name):
    frame = queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    ours = sorted(tuple(map(shown, row)) for row in frame.select(*columns).collect())
    found = database.execute(oracle_sql()[name])
    places = [[d[0] for d in found.description].index(c) for c in columns]
    assert ours == sorted(tuple(shown(row[i]) for i in places) for row in found.fetchall())
