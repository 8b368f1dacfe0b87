"""Registered queries against their SQL on the smallest given tables.

A query that writes thousands of folders is left to ``tools/compare.py``, which runs all of them.
"""

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from tierline.plans import catalog, equivalents

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("lineitem", "orders", "customer", "nation", "embeddings")
# Writes a folder for each of 2,400 days.
WRITES_DAYS = {"vacuum_candidates"}
ROWS_ONLY = {"train_forecaster_metrics", "knn_index"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql_or_is_known_to_have_none():
    assert set(catalog.QUERIES) - set(equivalents.SQL) == ROWS_ONLY
    assert set(equivalents.SQL) <= set(catalog.QUERIES)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["event_date", "country", "gross_revenue", "order_count", "unique_customers"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(equivalents.SQL) - WRITES_DAYS))
def test_same_rows_as_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    answer = duck.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in at) for r in answer.fetchall()), key=str)
    assert mine == theirs
    assert mine
