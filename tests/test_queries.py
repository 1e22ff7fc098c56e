import pytest

from loomline.plans import queries as core
from tests.sqlcheck import connection, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same(spark, con, core.queries()[name], core.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_query_runs(spark, name):
    assert len(core.queries()[name](spark, SF).toArrow().column_names) > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
