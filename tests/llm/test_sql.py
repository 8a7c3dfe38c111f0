"""Registered queries of the training-data operators against their SQL."""

import duckdb
import pytest

from strandweave.llm import queries

from ..test_queries import SF, plain


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = c.execute(queries.ORACLES[name])
    names, df = [d[0] for d in cur.description], queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want and want
