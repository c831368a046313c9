"""Every registered query runs; those with SQL agree with it row by row.

Nothing is broadcast here, so the plans are those of large tables.
"""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import plan
from scripts.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, engine, no_broadcast, name):
    frame = QUERIES[name](spark, FOLDER)
    text = plan(frame)
    assert "NestedLoop" not in text and "Cartesian" not in text and "PythonUDF" not in text
    result = engine.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, result.fetchall())


# the other model queries are compared above
@pytest.mark.parametrize("name", ["m15_score_churn"])
def test_rows_only(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_all_inventory_ids_are_registered():
    wanted = [f"s{i}_" for i in range(1, 11)] + [f"p{i}_" for i in range(1, 19)] + [f"j{i}_" for i in range(1, 17)]
    wanted += [f"a{i}_" for i in range(1, 19)] + [f"w{i}_" for i in range(1, 5)] + [f"k{i}_" for i in range(1, 5)]
    wanted += [f"u{i}_" for i in range(1, 5)] + [f"f{i}_" for i in range(1, 17)] + [f"t{i}_" for i in range(1, 8)]
    wanted += [f"m{i}_" for i in range(1, 16)] + [f"r{i}_" for i in range(1, 6)] + [f"c{i}_" for i in range(1, 11)]
    assert [w for w in wanted if not any(name.startswith(w) for name in QUERIES)] == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["mobile", "value"]
