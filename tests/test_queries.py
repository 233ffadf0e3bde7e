"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import table

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle_sql()
#: Whole searches and full runs of minutes each; check.py compares them.
LONG = {"m22_auto_fit", "m23_predict", "m24_leaderboard", "m28_train_score"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_entry(spark):
    assert entry(spark).count() == 13


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LONG))
def test_query_equals_its_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    ours = table(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ours == table(columns, result.fetchall())
