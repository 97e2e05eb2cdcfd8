"""The registered queries against their SQL, on the driver's smallest tables."""

import pytest
from tables import DATA
from oracle import check

from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    check(spark, queries.QUERIES[name], queries.ORACLES[name])


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_on_an_empty_table(spark, tmp_path, name):
    for t in ("documents", "conversations", "embeddings", "pages"):
        spark.read.parquet(str(DATA / f"sf0.001/{t}.parquet")).limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
