"""Every named query gives the rows of its oracle, at the smallest scale."""

import compare
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert compare.compare(db, df, ORACLES[name]) is None
    else:
        assert df.collect()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "status" in df.columns
