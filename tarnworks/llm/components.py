"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.session import staged


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (a, b).

    Alternating rounds of large-star and small-star: each node hangs its larger,
    then its smaller neighbours onto its smallest one, until every link leads to
    the smallest node of its component. Neighbourhoods are never gathered: a
    round is an aggregate (the minimum) and a join by node.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("m_u"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("m_u")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "m_u")
        small = large.join(least, F.col("u") == F.col("m_u")).select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = staged(small.select("e.u", "e.v").where("u <> v").distinct(), "cc-small")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    own = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return staged(own.unionByName(roots.join(own.select("node"), "node", "left_anti")), "cc")
