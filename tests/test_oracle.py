"""Every registered query against a second engine on the same tables."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from cohortlake.plans.catalog import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows):
    return sorted(rows, key=lambda row: [(v is not None, type(v).__name__, v or 0) for v in row])


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    mine = [tuple(row[c] for c in columns) for row in df.collect()]
    result = oracle.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert comparable(mine) == comparable(theirs)
    assert mine


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:3] == ["trial_id", "drug", "patient_count"]
    assert df.count() == 15


@pytest.mark.parametrize("partitions", [1, 8])
def test_result_does_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = QUERIES["cohort_stats"](spark, SF_DIR).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    again = QUERIES["cohort_stats"](spark, SF_DIR).collect()
    assert sorted(rows) == sorted(again)
