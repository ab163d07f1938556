import pytest
from oracle import actual, expected

from scriptorium import registry

registry.load()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    if name in registry.ORACLES:
        assert actual(df) == expected(registry.ORACLES[name], sf_dir)
    else:
        assert df.columns
        df.collect()
