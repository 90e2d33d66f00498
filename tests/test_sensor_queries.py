"""Every sensor query against its SQL on the small tables."""

import pytest

from tests.compare import connect, same
from tests.conftest import DATA
from wattloom.plans import catalog

SF = f"{DATA}/sf0.01"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, con, name):
    same(catalog.queries()[name](spark, SF), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_repeatable(spark, name):
    query = catalog.queries()[name]
    first = sorted(map(str, query(spark, SF).collect()))
    assert first and first == sorted(map(str, query(spark, SF).collect()))


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 53
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
