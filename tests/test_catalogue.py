import pytest

from millrace.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(name, spark, data, duck, same):
    same(catalogue.queries()[name](spark, data), duck.sql(catalogue.oracle_sql()[name]))


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_runs(name, spark, data):
    assert catalogue.queries()[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
