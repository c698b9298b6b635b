"""Registered queries against their oracle SQL at the smallest scale."""

import pytest

from seqloom.llm import queries
from seqloom.plans.compare import check

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    message = check(spark, SF, [name], queries.QUERIES, queries.ORACLES)[name]
    assert message.startswith("ok"), message
