import pytest
from sqlcheck import connect, rows

from wirelake.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, data, name):
    got = catalog.QUERIES[name](spark, data).toPandas()
    want = connect(data).execute(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() >= 0


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_window_reaches_the_scan(spark, data):
    df = catalog.QUERIES["window_filter"](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(published_at" in plan and "summary" not in plan
