"""Every registered query with a statement equals it on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_its_statement(spark, db, name):
    df = queries()[name](spark, FOLDER)
    mine = canonical(df.columns, df.collect())
    cursor = db.execute(STATEMENTS[name])
    theirs = canonical([c[0] for c in cursor.description], cursor.fetchall())
    assert mine[0] == theirs[0]
    assert len(mine[1]) == len(theirs[1])
    assert mine[1] == theirs[1]


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1
