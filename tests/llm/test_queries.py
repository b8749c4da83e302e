import re

import pytest

from tarnworks.llm import queries
from tests.oracle import needs_tables, same


@needs_tables
@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_and_sql_agree(spark, name):
    same(spark, queries.queries()[name], queries.oracle_sql()[name])


def test_one_query_for_each_operator():
    names = [n for n in queries.queries() if n != "pipeline"]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries.queries()
