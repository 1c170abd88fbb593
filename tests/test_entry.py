"""The driver contract, and every SQL-checked query against DuckDB on the smallest tables."""

import datetime as dt
import math
import os
import random

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def shown(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted(tuple(shown(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = sorted(tuple(shown(row[i]) for i in places) for row in result.fetchall())
    assert mine == theirs


@needs_data
def test_entry_returns_the_feature_table(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 31 and df.count() == 5698


def test_run_summary_reports_the_accuracy(spark, tmp_path):
    """The whole run's summary, equal to its SQL, says that the model was scored."""
    start, draw = dt.datetime(1995, 1, 2), random.Random(5)
    parts = [(i, f"Brand#{i}", 1000.0 + i) for i in range(1, 9)]
    trades = [
        (n, 1, part, 1, 5.0, draw.uniform(0.0, 0.1), start + dt.timedelta(days=n))
        for n in range(120) for part, _, _ in parts
    ]
    for name, rows, schema in (
        ("part", parts, "p_partkey bigint, p_brand string, p_retailprice double"),
        ("lineitem", trades,
         "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
         "l_quantity double, l_discount double, l_shipdate timestamp"),
    ):
        table = spark.createDataFrame(rows, schema).coalesce(1)
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    found = contract.queries()["run_summary"](spark, str(tmp_path)).first().asDict()
    assert found["accuracy_in_range"] is True
    duck = duckdb.connect()
    for name in ("part", "lineitem"):
        duck.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    expected = duck.execute(contract.oracle_sql()["run_summary"])
    names = [column[0] for column in expected.description]
    assert found == dict(zip(names, expected.fetchone()))
