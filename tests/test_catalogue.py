import pytest

from tarnworks.plans import catalogue
from tests.oracle import SF_DIR, needs_tables, same


@needs_tables
@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_and_sql_agree(spark, name):
    same(spark, catalogue.QUERIES[name], catalogue.SQL[name])


def test_entry_has_sql_for_every_query_of_the_catalogue():
    import __spark_entry__

    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries()) and set(catalogue.SQL) == set(catalogue.QUERIES)


@needs_tables
def test_adjacency_over_all_edges(spark):
    edges = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_custkey", "o_orderkey").distinct().count()
    assert sum(len(r.parents.split(",")) for r in catalogue.QUERIES["adjacency_all"](spark, SF_DIR).collect()) == edges
