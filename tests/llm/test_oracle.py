import pytest

from corvane.llm import registry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    compare(spark, con, name, registry.queries()[name], registry.oracle_sql()[name], SF)


def test_what_sql_cannot_express():
    """Unicode normal forms, hashes chosen by the method, trained weights, merges and rounding by hash."""
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"op2_substring_dedup", "op6_fingerprints", "op8_language_id", "op9_byte_bpe", "op10_mix_sources"}
