"""Every registered query of the engine against its SQL, at the smallest scale."""

import duckdb
import pytest

from strandweave.plans import more, oracles, queries

from . import test_queries
from .test_queries import SF, plain

QUERIES, ORACLES = queries.QUERIES | more.QUERIES, oracles.ORACLES | more.ORACLES


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(test_queries.SAMPLE)))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
