import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, rows_of
from meshroad.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    cur = db.execute(oracle_sql()[name])
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(cur.fetchall(), [c[0] for c in cur.description])


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry_reports_matched_crashes(spark, sf_dir):
    assert sum(r.filled for r in entry(spark).collect()) == 12
