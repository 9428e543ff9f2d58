"""Every registered query of the library against its SQL."""

import pytest
from helpers import connect, rows_of, rows_of_sql

from corpusloom import catalogue


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf, con, name):
    got = rows_of(catalogue.QUERIES[name](spark, sf))
    if name in catalogue.ORACLES:
        assert got == rows_of_sql(con, catalogue.ORACLES[name])
    else:
        assert got[1]


def test_entry():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
