import pytest
from tests.conftest import DATA, assert_same

from orrery.plans.oracle import ORACLE_SQL
from orrery.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, DATA), ORACLE_SQL[name], duck)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
