"""The river graph as a table of typed edges (ft, fn, tt, tn): from a node's number to a node's number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.ids import typed
from tarnworks.session import staged, staged_by

#: Node types at which an edge may begin and end.
FROM_TYPES, TO_TYPES = (0, 2), (1, 3, 4)

#: Rounds of a search whose tables are read one by one before they become one.
FOLD = 16


def typed_edges(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("ft").isin(*FROM_TYPES) & F.col("tt").isin(*TO_TYPES))


def adjacency(edges: DataFrame) -> DataFrame:
    """tn, parents: the distinct numbers that flow into tn, sorted."""
    return edges.groupBy("tn").agg(F.array_sort(F.collect_set("fn")).alias("parents"))


def downstream_first(edges: DataFrame) -> DataFrame:
    """fn, tn of the first edge of each fn by ``pos``."""
    return edges.groupBy("fn").agg(F.min_by("tn", "pos").alias("tn"))


def upstream(edges: DataFrame, outlets: DataFrame, with_sibling: bool = False) -> DataFrame:
    """node: the outlets and all that flows into them.

    With ``with_sibling`` the search starts at each outlet's downstream node too,
    so branches that meet the outlet's there are found; that node itself is
    not in the result unless it is reached. Rounds follow the edges up from the
    last round's nodes; nodes seen before are dropped, so cycles end. Edges are written
    once, in buckets by where they lead, so no round moves them; every round writes its
    new nodes alone, and the rounds' tables become one after ``FOLD`` of them, so a
    deep network has no deep plan.
    """
    edges = staged_by(edges.select("fn", "tn", *(["pos"] if "pos" in edges.columns else [])), "tn", "upstream-edges")
    seen = staged(outlets.select(F.col(outlets.columns[0]).cast("bigint").alias("node")).distinct(), "upstream-0")
    frontier = seen
    if with_sibling:
        order = edges if "pos" in edges.columns else edges.withColumn("pos", F.col("tn"))
        down = downstream_first(order).join(seen.withColumnRenamed("node", "fn"), "fn", "left_semi").select(F.col("tn").alias("node"))
        frontier = staged(seen.union(down).distinct(), "upstream-seeds")
    tables = [seen]
    while True:
        seen = reduce(DataFrame.union, tables)
        found = edges.join(frontier, F.col("tn") == F.col("node"), "left_semi").select(F.col("fn").cast("bigint").alias("node")).distinct()
        frontier = staged(found.join(seen, "node", "left_anti"), "upstream-frontier")
        if frontier.isEmpty():
            return seen
        tables = [*tables, frontier] if len(tables) < FOLD else [staged(seen, "upstream-seen"), frontier]


def upstream_of_tree(edges: DataFrame, outlet: int) -> DataFrame:
    """node: the outlet and all that flows into it, where every node has one downstream node.

    Pointers double: after round k every node knows whether the outlet is within
    2^k steps, so a network of depth d takes log2(d) rounds instead of d.
    """
    to = F.when(F.col("fn") != outlet, F.col("tn"))
    nodes = edges.select(F.col("fn").cast("bigint").alias("node"), to.cast("bigint").alias("to"), (F.col("fn") == outlet).alias("in"))
    state = staged(nodes.withColumn("in", F.col("in") | F.coalesce(F.col("to") == outlet, F.lit(False))), "tree-0")
    before = -1
    while True:
        far = state.select(F.col("node").alias("f_node"), F.col("to").alias("f_to"), F.col("in").alias("f_in"))
        ahead = state.join(far, F.col("to") == F.col("f_node"), "left")
        found = F.col("in") | F.coalesce("f_in", F.lit(False))
        state = staged(ahead.select("node", F.when(~found, F.col("f_to")).alias("to"), found.alias("in")), "tree")
        counts = state.agg(F.count_if("in"), F.count("to")).first()
        if counts[1] == 0 or counts == before:
            break
        before = counts
    own = edges.sparkSession.range(1).select(F.lit(outlet).cast("bigint").alias("node"))
    return state.where("in").select("node").union(own).distinct()


def nexus_ids(edges: DataFrame, selection: DataFrame, outlets: DataFrame) -> DataFrame:
    """id: ``nex-n`` for each selected n with a selected parent, and for each outlet's downstream node."""
    chosen = selection.select(F.col("node").alias("_n"))
    with_parent = edges.join(chosen, F.col("tn") == F.col("_n"), "left_semi").join(chosen, F.col("fn") == F.col("_n"), "left_semi").select(F.col("tn").cast("bigint").alias("n"))
    order = edges if "pos" in edges.columns else edges.withColumn("pos", F.col("tn"))
    below = downstream_first(order).join(outlets.select(F.col(outlets.columns[0]).alias("_n")), F.col("fn") == F.col("_n"), "left_semi").select(F.col("tn").cast("bigint").alias("n"))
    return with_parent.union(below).where(F.col("n").isNotNull()).distinct().select(typed("nex", F.col("n")).alias("id"))
