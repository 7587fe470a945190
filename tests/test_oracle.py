import pytest
from tests.oracle import compare

from palimpsest.plans.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, name):
    compare(spark, QUERIES[name], ORACLE[name], small)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "__action" in df.columns
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())
