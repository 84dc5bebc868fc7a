"""Every registered query against its SQL on a second engine."""

import contextlib
import datetime
import io
import math
import os

import pytest

import __spark_entry__ as spark_entry

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
QUERIES = spark_entry.queries()
SQL = spark_entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def multiset(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=str)


def compare(frame, duck, name):
    columns = sorted(frame.columns)
    found = frame.select(*[f"`{c}`" for c in columns]).collect()
    if name not in SQL:
        assert found
        return
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = [[row[i] for i in at] for row in result.fetchall()]
    assert multiset(found) == multiset(expected)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def plan_of(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    plan = plan_of(frame)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    compare(frame, duck, name)


@pytest.mark.parametrize("name, order", [
    ("select_all_ordered", "s_name"),
    ("order_by_keys", "c_mktsegment ASC NULLS LAST, c_acctbal DESC NULLS FIRST, c_custkey ASC NULLS LAST"),
])
def test_order_of_the_result(spark, duck, name, order):
    found = [tuple(plain(v) for v in row) for row in QUERIES[name](spark, SF_DIR).collect()]
    expected = duck.execute(f"SELECT * FROM ({SQL[name]}) ORDER BY {order}").fetchall()
    assert found == [tuple(plain(v) for v in row) for row in expected]
