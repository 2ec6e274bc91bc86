"""Each query against its SQL over the whole sf0.01 tables."""

import pytest

from __spark_entry__ import CATALOG, entry, oracle_sql, queries
from comparison import duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    got_columns, got = spark_rows(queries()[name](spark, SF_DIR))
    want_columns, want = duck_rows(con, oracle_sql()[name])
    assert got_columns == want_columns
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(CATALOG) - set(oracle_sql())))
def test_scores_every_fold(spark, name):
    rows = queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert sorted({r.fold for r in rows}) == [0, 1, 2, 3, 4]
