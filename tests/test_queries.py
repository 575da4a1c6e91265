"""Every query against its SQL on the smallest tables, and the entry module."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tickloom.plans import queries as Q

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_equals_its_sql(spark, db, name):
    df = Q.queries()[name](spark, FOLDER)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(Q.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert found == rows_of(names, cursor.fetchall())


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_alignment_plan_has_one_exchange_and_no_python(spark):
    df = Q.QUERIES["flagship_book_and_flow"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["jn04_forward_assign", "st02_st06_deep_book"])
def test_no_window_runs_to_the_end_of_its_partition_from_every_row(spark, name):
    """A frame from a row to the partition's end is computed anew for every row; whole-partition frames are not."""
    plan = Q.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "currentrow$(), unboundedfollowing$()" not in plan and ", unboundedfollowing$()" not in plan.replace("unboundedpreceding$(), unboundedfollowing$()", "")


def test_visible_levels_need_no_shuffle(spark):
    from tickloom.operators import deep_book
    from tickloom.plans import bindings as B

    books = B.books(spark, FOLDER)
    frames = books.select("symbol", "trading_date", "event_us", books["seq"].alias("frame_no"), F.struct("bid_levels", "ask_levels").alias("book_asof"))
    assert "Exchange" not in deep_book.visible_levels(frames)._jdf.queryExecution().executedPlan().toString()
