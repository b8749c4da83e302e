"""An index of a tree-like network: all that flows into a node is a range of numbers.

Nodes are numbered so that each is followed by all nodes upstream of it. A node's number is the sum, over its
way down to the root, of how many numbers it comes behind the next node: 1, and the sizes of the
branches before it. Both the sizes and these sums come by pointer doubling, once, when the index is
written. A search then is a filter on a range, which the Parquet scan takes: files and row groups of other numbers are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.operators.network import _within, _without_cycles, placed_at_outlets, total_drainage
from tarnworks.session import by_key, staged

#: Numbers of siblings that one task sums at most, as a power of two.
STRETCH = 16

#: Outlets whose ranges are given to the scan as a filter; for more of them, each node looks for the first outlet downstream.
RANGES = 256


def interval_index(edges: DataFrame) -> DataFrame:
    """node, to, first, last: the subtree of a node has the numbers first to last; edges: fn, tn.

    Every node must have one downstream node (ValueError otherwise); nodes that no edge begins at are roots. Cycles are cut
    behind their smallest node.
    """
    pairs = staged(edges.select(F.col("fn").cast("bigint").alias("n"), F.col("tn").cast("bigint").alias("to")).where("n IS NOT NULL").distinct(), "interval-edges")
    if not pairs.groupBy("n").count().where("count > 1").isEmpty():
        raise ValueError("a node flows into several")
    roots = pairs.where("to IS NOT NULL").select(F.col("to").alias("n")).distinct().join(by_key(pairs.select("n")), "n", "left_anti")
    nodes = _without_cycles(_within(pairs.unionByName(roots.withColumn("to", F.lit(None).cast("bigint")))))
    sized = staged(total_drainage(nodes.withColumn("area", F.lit(1).cast("bigint"))).select("n", "to", F.col("total").alias("size")), "interval-sizes")
    # Sizes of the siblings before each: by stretches of numbers, then within them, so that a node with very many inflows is no task's.
    sized = sized.withColumn("stretch", F.shiftright("n", STRETCH))
    stretches = sized.groupBy("to", "stretch").agg(F.sum("size").alias("sizes"))
    earlier = F.sum("sizes").over(Window.partitionBy("to").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    stretches = stretches.select(F.col("to").alias("s_to"), F.col("stretch").alias("s_stretch"), F.coalesce(earlier, F.lit(0)).alias("earlier"))
    inside = F.sum("size").over(Window.partitionBy("to", "stretch").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    behind = sized.withColumn("inside", F.coalesce(inside, F.lit(0))).join(by_key(stretches), F.col("to").eqNullSafe(F.col("s_to")) & (F.col("stretch") == F.col("s_stretch")))
    behind = staged(behind.select("n", "to", "size", (F.col("earlier") + F.col("inside") + 1).alias("behind")), "interval-behind")
    state = behind.select("n", F.col("to").alias("far"), F.col("behind").alias("first"))
    while not state.where("far IS NOT NULL").isEmpty():
        ahead = state.select(F.col("n").alias("a_n"), F.col("far").alias("a_far"), F.col("first").alias("a_first"))
        grown = state.join(by_key(ahead), F.col("far") == F.col("a_n"), "left")
        state = staged(grown.select("n", F.col("a_far").alias("far"), (F.col("first") + F.coalesce("a_first", F.lit(0))).alias("first")), "interval")
    numbers = state.select(F.col("n").alias("i_n"), "first")
    return behind.join(by_key(numbers), F.col("n") == F.col("i_n")).select(F.col("n").alias("node"), "to", "first", (F.col("first") + F.col("size") - 1).alias("last"))


def write_index(edges: DataFrame, path: str) -> None:
    """The index as Parquet, files and rows in the order of the numbers."""
    interval_index(edges).repartitionByRange("first").sortWithinPartitions("first").write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, without those inside others or next to them."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def upstream(index: DataFrame, outlets: DataFrame, with_sibling: bool = False) -> DataFrame:
    """node: the outlets and all that flows into them, as :func:`graph.upstream` finds it on a tree.

    With ``with_sibling`` also the branches that meet an outlet's at its downstream node: the range of that node without its own number.
    Outlets that are not in the index are in the result. Up to ``RANGES`` outlets are looked up and become ranges of a pushed filter.
    """
    wanted = outlets.select(F.col(outlets.columns[0]).cast("bigint").alias("node")).where("node IS NOT NULL").distinct()
    some = [r.node for r in wanted.limit(RANGES + 1).collect()]
    if len(some) > RANGES:
        wanted = staged(wanted, "interval-outlets")
        starts = wanted
        tree = index.select(F.col("node").alias("n"), "to")
        if with_sibling:
            below = tree.join(wanted, F.col("n") == F.col("node"), "left_semi").select(F.col("to").alias("node")).where("node IS NOT NULL").distinct()
            starts = staged(below.join(wanted, "node", "left_anti").unionByName(wanted), "interval-starts")
        at = placed_at_outlets(tree, starts)
        found = at.join(by_key(starts), F.col("at") == F.col("node"), "left_semi").select("n")
        # a node that only stands below an outlet is reached if what it flows into is
        ahead = tree.join(by_key(found.withColumnRenamed("n", "f_n")), F.col("to") == F.col("f_n"), "left_semi").select("n")
        reached = found.join(by_key(starts), F.col("n") == F.col("node"), "left_anti").unionByName(ahead)
        return reached.withColumnRenamed("n", "node").unionByName(wanted).distinct()
    known = index.where(F.col("node").isin(some)).select("node", "to", "first", "last").collect() if some else []
    ranges = [(r["first"], r["last"]) for r in known]
    if with_sibling:
        below = sorted({r.to for r in known if r.to is not None})
        ranges += [(r["first"] + 1, r["last"]) for r in (index.where(F.col("node").isin(below)).select("first", "last").collect() if below else [])]
    inside = F.lit(False)
    for low, high in _joined([r for r in ranges if r[0] <= r[1]]):
        inside = inside | F.col("first").between(low, high)
    return index.where(inside).select("node").unionByName(wanted.join(index.select("node").where(F.col("node").isin(some)), "node", "left_anti"))
