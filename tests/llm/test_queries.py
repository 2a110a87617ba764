"""Registered corpus queries beside their SQL twins."""

import pytest

from tabloom import llm
from tests.compare import difference

QUERIES, SQL = llm.all_queries(), llm.all_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None
