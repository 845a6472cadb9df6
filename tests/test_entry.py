import os

import duckdb
import pytest

import __spark_entry__
from limnos.queries import oracle_sql, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


def plain(rows):
    text = lambda x: f"{x:.6f}" if isinstance(x, float) else str(x).removesuffix(" 00:00:00")
    return sorted(tuple(map(text, r)) for r in rows)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_queries_equal_their_sql(name, spark, db):
    got = __spark_entry__.queries()[name](spark, SF)
    want = db.execute(oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert plain(got.select(*names).collect()) == plain(want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
