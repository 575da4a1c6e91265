"""The corpus queries that SQL can express, against it."""

import duckdb

from tickloom.llm import queries as Q


def test_queries_equal_their_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    for name, sql in Q.oracle_sql().items():
        df = Q.queries()[name](spark, folder)
        cursor = con.execute(sql)
        order = [[d[0] for d in cursor.description].index(c) for c in df.columns]
        want = sorted(tuple(r[i] for i in order) for r in cursor.fetchall())
        assert sorted(map(tuple, df.collect())) == want != []
