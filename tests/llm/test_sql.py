import pytest
from oracle import actual, expected

from scriptorium.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_against_sql(spark, sf_dir, name):
    assert actual(queries()[name](spark, sf_dir)) == expected(oracle_sql()[name], sf_dir)
