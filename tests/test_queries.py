import pytest
from tables import DATA
from oracle import check
from pyspark.sql import DataFrame

from tidemark.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, name):
    check(spark, registry.QUERIES[name], registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, str(DATA / "sf0.001")).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert isinstance(df, DataFrame) and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
