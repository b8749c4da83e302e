"""Queries of the operators over the test tables, each with SQL that says the same.

The tables stand for a river network: parts are nodes that flow into the node of
half their number, orders are flow lines, lineitems a crosswalk and grid cells,
customers points of interest.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.functions import display, geometry
from tarnworks.functions.ids import number_of, typed, whole, with_prefix
from tarnworks.functions.text import compact_time, fixed, grouped, low_bytes
from tarnworks.operators import aggregates, attributes, dissolve, features, graph, intervals, network, pointers, raster, relational, simplify, stems, tiles
from tarnworks.operators.subset import subset, subset_lakes
from tarnworks.plans import preparation as plan
from tarnworks.session import by_key, dealt, fresh_path, staged
from tarnworks.sources.files import FILES, read_edges, read_texts, write_texts
from tarnworks.sources.geopackage import read_container, write_containers
from tarnworks.sources.geotiff import read_geotiff, write_geotiff
from tarnworks.sources.layers import catalog, read_ids

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _edges(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").where("p_partkey >= 1")
    return part.select((F.col("p_size") % 3).alias("ft"), F.col("p_partkey").alias("fn"), (F.col("p_partkey") % 5).alias("tt"), F.floor(F.col("p_partkey") / 2).alias("tn"))


def _outlet(spark, n: int = 5) -> DataFrame:
    return spark.range(n, n + 1).select(F.col("id").alias("node"))


_UP = "WITH RECURSIVE e AS (SELECT p_partkey AS fn, p_partkey // 2 AS tn FROM part WHERE p_partkey >= 1), u(n) AS (SELECT CAST(5 AS BIGINT) UNION SELECT e.fn FROM e JOIN u ON e.tn = u.n) "

# ---- the graph


@query(_UP + "SELECT n AS node FROM u")
def upstream_closure(spark, sf_dir):
    return graph.upstream(_edges(spark, sf_dir), _outlet(spark))


@query(_UP + "SELECT n AS node FROM u")
def upstream_closure_doubling(spark, sf_dir):
    return graph.upstream_of_tree(_edges(spark, sf_dir), 5)


@query(
    "WITH RECURSIVE e AS (SELECT p_partkey AS fn, p_partkey // 2 AS tn FROM part WHERE p_partkey >= 1 AND p_size % 3 IN (0, 2) AND p_partkey % 5 IN (1, 3, 4)), "
    "u(n) AS (SELECT CAST(5 AS BIGINT) UNION SELECT e.fn FROM e JOIN u ON e.tn = u.n) SELECT n AS node FROM u"
)
def upstream_closure_typed(spark, sf_dir):
    return graph.upstream(graph.typed_edges(_edges(spark, sf_dir)), _outlet(spark))


@query(
    "WITH RECURSIVE e AS (SELECT p_partkey AS fn, p_partkey // 2 AS tn FROM part WHERE p_partkey >= 1), "
    "u(n) AS (SELECT CAST(5 AS BIGINT) UNION SELECT e.fn FROM e JOIN u ON e.tn = u.n), s(n) AS (SELECT fn FROM e WHERE tn = 2 UNION SELECT e.fn FROM e JOIN s ON e.tn = s.n) "
    "SELECT n AS node FROM u UNION SELECT n FROM s"
)
def upstream_with_sibling(spark, sf_dir):
    return graph.upstream(_edges(spark, sf_dir), _outlet(spark), with_sibling=True)


@query("SELECT o_custkey AS fn, arg_min(o_orderkey // 7, o_orderkey) AS tn FROM orders GROUP BY 1")
def downstream_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return graph.downstream_first(orders.select(F.col("o_custkey").alias("fn"), F.floor(F.col("o_orderkey") / 7).alias("tn"), F.col("o_orderkey").alias("pos")))


@query("SELECT tn, string_agg(CAST(fn AS VARCHAR), ',' ORDER BY fn) AS parents FROM (SELECT DISTINCT o_custkey % 100 AS tn, o_orderkey % 50 AS fn FROM orders) GROUP BY 1")
def adjacency_sets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    found = graph.adjacency(orders.select((F.col("o_custkey") % 100).alias("tn"), (F.col("o_orderkey") % 50).alias("fn")))
    return found.select("tn", F.array_join(F.transform("parents", lambda x: x.cast("string")), ",").alias("parents"))


@query("SELECT o_custkey AS tn, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS parents FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders) GROUP BY 1")
def adjacency_all(spark, sf_dir):
    found = graph.adjacency(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("tn"), F.col("o_orderkey").alias("fn")))
    return found.select("tn", F.array_join(F.transform("parents", lambda x: x.cast("string")), ",").alias("parents"))


@query(_UP + "SELECT DISTINCT 'nex-' || e.tn AS id FROM e WHERE e.tn IN (FROM u) AND e.fn IN (FROM u) UNION SELECT 'nex-2'")
def nexus_ids(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return graph.nexus_ids(edges, graph.upstream(edges, _outlet(spark)), _outlet(spark))


@query(
    _UP + "SELECT l_partkey AS node, round(sum(l_quantity * l_extendedprice) / sum(l_extendedprice), 6) AS mean_quantity, count(*) AS n FROM lineitem WHERE l_partkey IN (FROM u) GROUP BY 1"
)
def upstream_weighted_mean(spark, sf_dir):
    lines = relational.members(table(spark, sf_dir, "lineitem"), "l_partkey", graph.upstream(_edges(spark, sf_dir), _outlet(spark)))
    mean = aggregates.weighted_mean(F.col("l_quantity"), F.col("l_extendedprice"), 6)
    return lines.groupBy(F.col("l_partkey").alias("node")).agg(mean.alias("mean_quantity"), F.count(F.lit(1)).alias("n"))


# ---- subsets


@query(_UP + "SELECT 'cat-' || p_partkey AS divide_id, p_name, p_size FROM part WHERE p_partkey IN (FROM u)")
def subset_divides(spark, sf_dir):
    divides = table(spark, sf_dir, "part").select(typed("cat", F.col("p_partkey")).alias("divide_id"), "p_name", "p_size")
    ids = graph.upstream(_edges(spark, sf_dir), _outlet(spark)).select(typed("cat", F.col("node")))
    return relational.members(divides, "divide_id", ids)


@query(_UP + "SELECT 'wb-' || o_orderkey AS id, o_totalprice FROM orders WHERE o_orderkey IN (FROM u)")
def subset_flowpaths(spark, sf_dir):
    flowpaths = table(spark, sf_dir, "orders").select(typed("wb", F.col("o_orderkey")).alias("id"), "o_totalprice")
    ids = graph.upstream(_edges(spark, sf_dir), _outlet(spark)).select(typed("wb", F.col("node")))
    return relational.members(flowpaths, "id", ids)


@query(
    _UP + ", k(id) AS (SELECT 'wb-' || n FROM u UNION SELECT 'nex-' || e.tn FROM e WHERE e.tn IN (FROM u) AND e.fn IN (FROM u) UNION SELECT 'nex-2'), "
    "t AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'wb-' ELSE 'nex-' END || l_partkey AS id, l_orderkey, l_quantity FROM lineitem) "
    "SELECT id, count(*) AS n, round(sum(l_quantity), 6) AS quantity FROM t WHERE id IN (FROM k) GROUP BY 1"
)
def subset_network(spark, sf_dir):
    prefix = F.when(F.col("l_linenumber") % 2 == 0, F.lit("wb-")).otherwise(F.lit("nex-"))
    rows = table(spark, sf_dir, "lineitem").select(F.concat(prefix, F.col("l_partkey").cast("string")).alias("id"), "l_quantity")
    edges = _edges(spark, sf_dir)
    selection = graph.upstream(edges, _outlet(spark))
    ids = selection.select(typed("wb", F.col("node")).alias("id")).unionByName(graph.nexus_ids(edges, selection, _outlet(spark)))
    return relational.members(rows, "id", ids).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey % 3 <> 0)")
def subset_lakes_via_pois(spark, sf_dir):
    poi = F.when(F.col("c_nationkey") % 3 != 0, F.col("c_custkey"))
    pois = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(poi.alias("poi_id"))
    lakes = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("poi_id"))
    return subset_lakes(lakes, pois).select("o_orderkey", F.col("poi_id").alias("o_custkey"))


@query(
    "WITH RECURSIVE e AS (SELECT p_partkey AS fn, p_partkey // 2 AS tn FROM part WHERE p_partkey >= 1), u(n) AS (SELECT CAST(5 AS BIGINT) UNION SELECT e.fn FROM e JOIN u ON e.tn = u.n), "
    "s(n) AS (SELECT fn FROM e WHERE tn = 2 UNION SELECT e.fn FROM e JOIN s ON e.tn = s.n), k AS (SELECT n FROM u UNION SELECT n FROM s), "
    "x AS (SELECT 'nex-' || e.tn AS id FROM e WHERE e.tn IN (FROM k) AND e.fn IN (FROM k) UNION SELECT 'nex-2' UNION SELECT 'wb-' || n FROM k), "
    "c AS (SELECT c_custkey, c_acctbal, CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END AS poi_id FROM customer WHERE c_custkey IN (FROM k)), "
    "t AS (SELECT 'divides' AS name, p_size AS v FROM part WHERE p_partkey IN (FROM k) UNION ALL SELECT 'flowpaths', p_size * 2 FROM part WHERE p_partkey IN (FROM k) "
    "UNION ALL SELECT 'nexus', p_size FROM part WHERE 'nex-' || p_partkey IN (FROM x) UNION ALL SELECT 'divide-attributes', l_quantity FROM lineitem WHERE l_partkey IN (FROM k) "
    "UNION ALL SELECT 'flowpath-attributes', l_tax FROM lineitem WHERE l_partkey IN (FROM k) UNION ALL SELECT 'flowpath-attributes-ml', s_acctbal FROM supplier WHERE s_suppkey IN (FROM k) "
    "UNION ALL SELECT 'hydrolocations', o_totalprice FROM orders WHERE o_custkey IN (FROM k) UNION ALL SELECT 'pois', c_acctbal FROM c "
    "UNION ALL SELECT 'network', l_quantity FROM lineitem WHERE (CASE WHEN l_linenumber % 2 = 0 THEN 'wb-' ELSE 'nex-' END) || l_partkey IN (FROM x) "
    "UNION ALL SELECT 'lakes', o_totalprice FROM orders WHERE o_custkey % 25 IN (SELECT poi_id FROM c WHERE poi_id IS NOT NULL)) "
    "SELECT name AS table_name, count(*) AS features, round(sum(v), 3) AS total FROM t GROUP BY 1"
)
def subset_tables(spark, sf_dir):
    """All ten tables of a subset, with the branches that meet the outlet's."""
    read = {n: table(spark, sf_dir, n) for n in ("part", "lineitem", "supplier", "orders", "customer")}
    part, lines = F.col("p_partkey"), F.col("l_partkey")
    either = F.when(F.col("l_linenumber") % 2 == 0, typed("wb", lines)).otherwise(typed("nex", lines))
    tables = {
        "divides": read["part"].select(typed("cat", part).alias("divide_id"), F.col("p_size").alias("v")),
        "flowpaths": read["part"].select(typed("wb", part).alias("id"), (F.col("p_size") * 2).alias("v")),
        "nexus": read["part"].select(typed("nex", part).alias("id"), F.col("p_size").alias("v")),
        "divide-attributes": read["lineitem"].select(typed("cat", lines).alias("divide_id"), F.col("l_quantity").alias("v")),
        "flowpath-attributes": read["lineitem"].select(typed("wb", lines).alias("id"), F.col("l_tax").alias("v")),
        "flowpath-attributes-ml": read["supplier"].select(typed("wb", F.col("s_suppkey")).alias("id"), F.col("s_acctbal").alias("v")),
        "hydrolocations": read["orders"].select(typed("wb", F.col("o_custkey")).alias("id"), F.col("o_totalprice").alias("v")),
        "pois": read["customer"].select(typed("wb", F.col("c_custkey")).alias("id"), F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey")).alias("poi_id"), F.col("c_acctbal").alias("v")),
        "network": read["lineitem"].select(either.alias("id"), F.col("l_quantity").alias("v")),
        "lakes": read["orders"].select((F.col("o_custkey") % 25).alias("poi_id"), F.col("o_totalprice").alias("v")),
    }
    edges = _edges(spark, sf_dir).withColumns({"ft": F.lit(0), "tt": F.lit(1)})
    kept = [t.select(F.lit(n).alias("table_name"), F.col("v").cast("double").alias("v")) for n, t in subset(tables, edges, _outlet(spark)).items()]
    return reduce(DataFrame.unionByName, kept).groupBy("table_name").agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("v"), 3).alias("total"))


# ---- corrections, joins, projections


@query(
    "WITH c AS (SELECT o_orderkey AS k, 1 AS ord, o_totalprice + 1 AS price, CASE WHEN o_orderkey % 2 = 0 THEN 'A' END AS status FROM orders WHERE o_orderkey % 97 = 0 "
    "UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 2 END, CASE WHEN o_orderkey % 5 = 0 THEN 'B' END FROM orders WHERE o_orderkey % 97 = 0), "
    "l AS (SELECT k, arg_max(price, ord) FILTER (price IS NOT NULL) AS price, arg_max(status, ord) FILTER (status IS NOT NULL) AS status FROM c GROUP BY 1) "
    "SELECT o_orderkey, round(coalesce(l.price, o_totalprice), 6) AS o_totalprice, coalesce(l.status, o_orderstatus) AS o_orderstatus FROM orders LEFT JOIN l ON l.k = o_orderkey"
)
def apply_corrections(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    wrong, key = orders.where("o_orderkey % 97 = 0"), F.col("o_orderkey")
    one = wrong.select(key.alias("flowpath"), (F.col("o_totalprice") + 1).alias("o_totalprice"), F.when(key % 2 == 0, "A").alias("o_orderstatus"), F.lit(1).alias("ord"))
    two = wrong.select(key.alias("flowpath"), F.when(key % 3 == 0, F.col("o_totalprice") + 2).alias("o_totalprice"), F.when(key % 5 == 0, "B").alias("o_orderstatus"), F.lit(2).alias("ord"))
    return relational.corrected(orders, one.unionByName(two), "o_orderkey", "ord").withColumn("o_totalprice", F.round("o_totalprice", 6))


@query(
    "WITH n AS (SELECT DISTINCT l_partkey, l_linenumber AS lengthkm, CAST(floor(l_quantity) AS BIGINT) % 3 AS area FROM lineitem) "
    "SELECT p_partkey AS divide_id, p_size, n.lengthkm, n.area AS tot_drainage_areasqkm FROM part LEFT JOIN n ON n.l_partkey = p_partkey"
)
def network_attrs_left_join(spark, sf_dir):
    divides = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("divide_id"), "p_size")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("divide_id"), F.col("l_linenumber").alias("flowpath_lengthkm"), (F.floor("l_quantity") % 3).alias("tot_drainage_areasqkm"))
    return network.with_network_attributes(divides, lines)


def _flowpaths(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(typed("fp", F.col("o_orderkey")).alias("flowpath_id"), typed("nex", F.floor(F.col("o_orderkey") / 2)).alias("flowpath_toid"), F.col("o_custkey").alias("flowline_id"), F.lit("m").alias("member_comid"), "o_totalprice")


@query(
    "SELECT 'cat-' || p_partkey AS divide_id, 'nex-' || (o_orderkey // 2) AS toid, 'wb-' || p_partkey AS id, '16' AS vpuid, p_size FROM part LEFT JOIN orders ON o_orderkey = p_partkey"
)
def reconcile_divides(spark, sf_dir):
    divides = table(spark, sf_dir, "part").select(typed("cat", F.col("p_partkey")).alias("divide_id"), typed("fp", F.col("p_partkey")).alias("flowpath_id"), "p_size")
    return network.reconciled_divides(divides, _flowpaths(spark, sf_dir), "16")


@query("SELECT 'wb-' || o_orderkey AS id, 'nex-' || (o_orderkey // 2) AS toid, o_totalprice, '16' AS vpuid FROM orders")
def reconcile_flowpaths(spark, sf_dir):
    return network.reconciled_flowpaths(_flowpaths(spark, sf_dir), "16")


@query(
    "WITH p AS (SELECT DISTINCT 'nex-' || o_orderkey AS id, o_custkey % 7 AS poi_id FROM orders WHERE o_custkey % 5 <> 0 UNION SELECT 'nex-' || o_orderkey, o_custkey % 7 + 10 FROM orders WHERE o_custkey % 11 = 0) "
    "SELECT 'nex-' || p_partkey AS id, 'wb-' || (p_partkey // 2) AS toid, p.poi_id, 'nexus' AS type, '16' AS vpuid FROM part LEFT JOIN p ON p.id = 'nex-' || p_partkey"
)
def reconcile_nexus(spark, sf_dir):
    nexus = table(spark, sf_dir, "part").select(typed("nex", F.col("p_partkey")).alias("nexus_id"), typed("fp", F.floor(F.col("p_partkey") / 2)).alias("nexus_toid"))
    orders = table(spark, sf_dir, "orders").select(typed("fp", F.col("o_orderkey")).alias("flowpath_id"), "o_custkey")
    one = orders.select("flowpath_id", F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey") % 7).alias("poi_id"))
    two = orders.where("o_custkey % 11 = 0").select("flowpath_id", (F.col("o_custkey") % 7 + 10).alias("poi_id"))
    return network.reconciled_nexus(nexus, one.unionByName(two), "16")


@query("SELECT DISTINCT id, toid FROM (SELECT 'wb-' || p_partkey AS id, 'nex-' || (p_partkey // 2) AS toid FROM part WHERE p_partkey >= 1 UNION SELECT 'nex-' || (p_partkey // 2), 'wb-' || (p_partkey // 2) FROM part WHERE p_partkey >= 1)")
def nexus_topology(spark, sf_dir):
    return network.nexus_topology(_edges(spark, sf_dir).select(F.col("fn").alias("n"), F.col("tn").alias("to")))


@query(
    "WITH l AS (SELECT o_orderkey, CASE WHEN o_custkey % 50 <> 0 THEN o_custkey % 50 END AS k FROM orders), r AS (SELECT CASE WHEN n_nationkey <> 0 THEN n_nationkey END AS k, n_name FROM nation) "
    "SELECT l.o_orderkey, l.k, r.n_name FROM l LEFT JOIN r ON l.k IS NOT DISTINCT FROM r.k"
)
def null_safe_left_join(spark, sf_dir):
    key = F.col("o_custkey") % 50
    left = table(spark, sf_dir, "orders").select("o_orderkey", F.when(key != 0, key).alias("k"))
    right = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") != 0, F.col("n_nationkey").cast("bigint")).alias("k"), "n_name")
    return relational.left_join(left, right, "k")


@query(
    "SELECT l_partkey, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS custkeys FROM lineitem JOIN orders ON o_orderkey = try_cast(CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_orderkey AS VARCHAR) END AS INT) GROUP BY 1"
)
def crosswalk_inner_join(spark, sf_dir):
    text = F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(F.col("l_orderkey").cast("string"))
    walk = table(spark, sf_dir, "lineitem").select("l_partkey", whole(text).alias("reference_id"))
    joined = walk.join(table(spark, sf_dir, "orders"), F.col("reference_id") == F.col("o_orderkey"))
    return joined.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("custkeys"))


@query(
    "SELECT divide_id, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c FROM (SELECT c_custkey AS divide_id, c_nationkey AS a, NULL AS b, NULL AS c FROM customer WHERE c_custkey % 2 = 0 "
    "UNION ALL SELECT c_custkey, NULL, c_custkey * 2, NULL FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, NULL, NULL, c_mktsegment FROM customer WHERE c_custkey % 5 = 0) GROUP BY 1"
)
def full_join_three(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("divide_id", F.col("c_custkey"))
    one = customer.where("c_custkey % 2 = 0").select("divide_id", F.col("c_nationkey").alias("a"))
    two = customer.where("c_custkey % 3 = 0").select("divide_id", (F.col("c_custkey") * 2).alias("b"))
    three = customer.where("c_custkey % 5 = 0").select("divide_id", F.col("c_mktsegment").alias("c"))
    return relational.full_join_all([one, two, three], "divide_id")


@query("SELECT o_orderkey, o_totalprice, '16' AS vpuid FROM orders")
def vpu_constant_column(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").withColumn("vpuid", F.lit("16"))


@query('SELECT p_partkey, p_size AS "geom_mean.p_size", p_retailprice AS "geom_mean.p_retailprice" FROM part')
def prefix_rename(spark, sf_dir):
    return relational.renamed_but(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), "p_partkey", lambda c: f"geom_mean.{c}")


@query("SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def drop_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    numbers = [c for c in lines.columns if c.startswith("l_") and dict(lines.dtypes)[c] == "double"]
    return lines.select(*numbers)


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query("SELECT o_orderkey, 'wb-' || o_orderkey AS wb, 'nex-' || o_orderkey AS nex, o_orderkey AS n FROM orders")
def typed_ids(spark, sf_dir):
    fp = typed("fp", F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", with_prefix(fp, "fp", "wb").alias("wb"), with_prefix(fp, "fp", "nex").alias("nex"), number_of(fp).alias("n"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 6")
def sorted_preview(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(6)


@query("SELECT c_custkey, sha256(c_name) AS sha, replace(c_name, '#', '%23') AS encoded, CAST(floor(c_acctbal) AS BIGINT) AS floored, regexp_replace(c_name, '^Customer', 'C') AS short FROM customer")
def scalar_functions(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select("c_custkey", F.sha2(name, 256).alias("sha"), F.url_encode(name).alias("encoded"), F.floor("c_acctbal").alias("floored"), F.regexp_replace(name, "^Customer", "C").alias("short"))


# ---- aggregates


@query(
    "WITH t AS (SELECT l_partkey AS divide_id, CASE WHEN l_quantity > 5 THEN l_quantity END AS x, l_extendedprice AS w, l_quantity / 7 AS e FROM lineitem), "
    "m AS (SELECT divide_id, CAST(floor(e) AS BIGINT) AS e, count(*) AS n FROM t GROUP BY 1, 2) "
    'SELECT t.divide_id, round(sum(x * w) FILTER (x IS NOT NULL) / sum(w) FILTER (x IS NOT NULL), 6) AS "mean.Coeff", round(sum(l * w) FILTER (l IS NOT NULL) / sum(w) FILTER (l IS NOT NULL), 6) AS "mean.Zmax", '
    '(SELECT max_by(e, n * 1000 + e) FROM m WHERE m.divide_id = t.divide_id) AS "mode.Expon" FROM (SELECT *, x * 2 AS l FROM t) t GROUP BY 1'
)
def groundwater_params(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    x = F.when(F.col("l_quantity") > 5, F.col("l_quantity"))
    rows = lines.select("l_partkey", x.alias("Coeff"), (x * 2).alias("Zmax"), F.col("l_extendedprice").alias("Area_sqkm"), F.floor(F.col("l_quantity") / 7).alias("Expon"))
    return rows.groupBy(F.col("l_partkey").alias("divide_id")).agg(
        aggregates.weighted_mean(F.col("Coeff"), F.col("Area_sqkm"), 6).alias("mean.Coeff"), aggregates.weighted_mean(F.col("Zmax"), F.col("Area_sqkm"), 6).alias("mean.Zmax"), aggregates.mode_of("Expon").alias("mode.Expon")
    )


@query(
    "WITH w AS (SELECT l_orderkey AS r, l_partkey AS d FROM lineitem), b AS (SELECT o_orderkey AS k, o_totalprice AS a, CAST(o_custkey % 13 AS DOUBLE) AS c FROM orders) "
    'SELECT d AS divide_id, round(sum(c * a) / sum(a), 6) AS "mean.Coeff", round(sum(2 * c * a) / sum(a), 6) AS "mean.Zmax" FROM w JOIN b ON r = k GROUP BY 1'
)
def groundwater_join(spark, sf_dir):
    walk = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("reference_id"), F.col("l_partkey").alias("divide_id"))
    c = (F.col("o_custkey") % 13).cast("double")
    basins = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ComID"), c.alias("Coeff"), F.col("o_totalprice").alias("Area_sqkm"), (2 * c).alias("Zmax"), c.alias("Expon"))
    return attributes.groundwater(walk, basins, digits=6).drop("mode.Expon")


@query(
    "WITH t AS (SELECT l_suppkey AS k, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS x, CASE WHEN NOT (l_linenumber = 5 AND l_suppkey % 4 = 0) THEN l_extendedprice END AS w FROM lineitem) "
    "SELECT k, CASE WHEN count(*) FILTER (x IS NOT NULL AND w IS NULL) = 0 THEN round(sum(x * w) FILTER (x IS NOT NULL) / sum(w) FILTER (x IS NOT NULL), 6) END AS mean FROM t GROUP BY 1"
)
def weighted_mean_nulls(spark, sf_dir):
    x, w = F.when(F.col("l_linenumber") != 3, F.col("l_quantity")), F.when(~((F.col("l_linenumber") == 5) & (F.col("l_suppkey") % 4 == 0)), F.col("l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), x.alias("x"), w.alias("w"))
    return rows.groupBy("k").agg(aggregates.weighted_mean(F.col("x"), F.col("w"), 6).alias("mean"))


_CHANNEL = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("SELECT o_custkey AS flowline_id, " + ", ".join(f"round(sum({c} * o_totalprice) / sum(o_totalprice), 5) AS {c}" for c in _CHANNEL) + " FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def channel_attrs_by_length(spark, sf_dir):
    walk = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("flowline_id"), F.col("o_orderkey").alias("reference_id"), F.col("o_totalprice").alias("lengthkm"))
    hydraulics = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("feature_id"), *_CHANNEL)
    return attributes.channels(walk, hydraulics, list(_CHANNEL), digits=5)


def _covered(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("divide_id"), F.col("l_quantity").alias("value"), F.col("l_linenumber").alias("coverage"))


@query("WITH t AS (SELECT l_partkey AS d, l_quantity AS v, sum(l_linenumber) AS w FROM lineitem GROUP BY 1, 2) SELECT d AS divide_id, max_by(v, w * 1000 + v) AS mode FROM t GROUP BY 1")
def zonal_mode(spark, sf_dir):
    return raster.zonal(_covered(spark, sf_dir), "mode", ["divide_id"], "mode")


@query("SELECT l_partkey AS divide_id, round(sum(l_quantity * l_linenumber) / sum(l_linenumber), 6) AS mean FROM lineitem GROUP BY 1")
def zonal_mean(spark, sf_dir):
    return raster.zonal(_covered(spark, sf_dir), "mean", ["divide_id"], "mean").withColumn("mean", F.round("mean", 6))


@query("SELECT l_partkey AS divide_id, round(exp(sum(ln(l_quantity) * l_linenumber) / sum(l_linenumber)), 6) AS geom_mean FROM lineitem WHERE l_quantity > 0 GROUP BY 1")
def zonal_geomean(spark, sf_dir):
    return raster.zonal(_covered(spark, sf_dir), "geometric_mean", ["divide_id"], "geom_mean").withColumn("geom_mean", F.round("geom_mean", 6))


@query(
    "WITH t AS (SELECT l_partkey AS d, degrees(atan2(sum(l_linenumber * sin(radians(l_quantity * 7))), sum(l_linenumber * cos(radians(l_quantity * 7))))) AS a FROM lineitem GROUP BY 1) "
    "SELECT d AS divide_id, round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 5) AS circ_mean FROM t"
)
def zonal_circular_mean(spark, sf_dir):
    cells = _covered(spark, sf_dir).withColumn("value", F.col("value") * 7)
    return raster.zonal(cells, "circular_mean", ["divide_id"], "circ_mean").withColumn("circ_mean", F.round("circ_mean", 5))


@query("SELECT l_partkey AS divide_id, l_suppkey AS cell, CAST(sum(l_linenumber) AS BIGINT) AS coverage, 'grid' AS grid_id FROM lineitem GROUP BY 1, 2")
def weight_grid(spark, sf_dir):
    cells = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("divide_id"), F.col("l_suppkey").alias("cell"), F.col("l_linenumber").alias("coverage"))
    return raster.weight_grid(cells, "grid")


@query("SELECT count(*) AS edges, count(DISTINCT p_partkey) AS nodes, count(*) FILTER (p_size % 3 IN (0, 2)) AS kept FROM part")
def graph_counts(spark, sf_dir):
    return table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("p_partkey").alias("nodes"), F.count_if((F.col("p_size") % 3).isin(0, 2)).alias("kept"))


# ---- grids


@query("SELECT 'a' AS name, CAST(l_suppkey AS BIGINT) AS cell, l_quantity AS value FROM lineitem WHERE l_linenumber <= 2 UNION ALL SELECT 'b', l_suppkey, l_quantity FROM lineitem WHERE l_linenumber > 4")
def raster_stack_union(spark, sf_dir):
    cells = table(spark, sf_dir, "lineitem").select("l_linenumber", F.col("l_suppkey").alias("cell"), F.col("l_quantity").alias("value"))
    return raster.stacked({"a": cells.where("l_linenumber <= 2").drop("l_linenumber"), "b": cells.where("l_linenumber > 4").drop("l_linenumber")})


@query("SELECT 'variable-' || l_linenumber AS name, CAST(l_suppkey AS BIGINT) AS cell, l_quantity AS value FROM lineitem")
def raster_stack_all(spark, sf_dir):
    cells = table(spark, sf_dir, "lineitem").select("l_linenumber", F.col("l_suppkey").alias("cell"), F.col("l_quantity").alias("value"))
    return raster.stacked({f"variable-{k}": cells.where(F.col("l_linenumber") == k).drop("l_linenumber") for k in range(1, 8)})


@query(
    "SELECT CAST(o_custkey AS BIGINT) AS col, CAST(o_orderkey % 300 AS BIGINT) AS row, CAST(max(o_totalprice) AS DOUBLE) AS value FROM orders GROUP BY 1, 2"
)
def cells_from_geotiff(spark, sf_dir):
    path = fresh_path(spark, "tiff")
    cells = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("bigint").alias("col"), (F.col("o_orderkey") % 300).alias("row"), F.col("o_totalprice").cast("double").alias("value"))
    write_geotiff(cells, path).write.format("noop").mode("overwrite").save()
    return read_geotiff(spark, path, ["col", "row", "value"], origin=(0.0, 0.0)).where("value IS NOT NULL")


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 1000")
def container_filtered(spark, sf_dir):
    path = fresh_path(spark, "containers")
    price = F.col("o_totalprice").cast("double").alias("o_totalprice")
    write_containers(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", price), path, "orders")
    layer = read_container(spark, path, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    return layer.where("o_orderstatus IN ('F', 'O') AND o_totalprice > 1000").drop("o_orderstatus")


@query(
    "SELECT o_custkey AS col, o_orderkey % 2 AS row, arg_max(o_totalprice, o_orderkey) FILTER (o_orderkey % 5 <> 0) AS value FROM orders GROUP BY 1, 2"
)
def mosaic_last_wins(spark, sf_dir):
    value = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice"))
    tiles = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("col"), (F.col("o_orderkey") % 2).alias("row"), value.alias("value"), F.col("o_orderkey").alias("tile"))
    return raster.mosaic(tiles)


def _neighbour(x: int, y: int) -> str:
    return f"LEFT JOIN g n{x + 1}{y + 1} ON n{x + 1}{y + 1}.c = g.c + {x} AND n{x + 1}{y + 1}.r = g.r + {y}"


@query(
    "WITH g AS (SELECT p_partkey % 50 AS c, p_partkey // 50 AS r, p_retailprice AS z FROM part), "
    "s AS (SELECT g.c, g.r, (n20.z + 2 * n21.z + n22.z - n00.z - 2 * n01.z - n02.z) / 8 AS e, (n02.z + 2 * n12.z + n22.z - n00.z - 2 * n10.z - n20.z) / 8 AS s FROM g "
    + " ".join(_neighbour(x, y) for x in (-1, 0, 1) for y in (-1, 0, 1) if (x, y) != (0, 0))
    + ") SELECT c AS col, r AS row, round(degrees(atan(sqrt(e * e + s * s))), 5) AS slope, round(CASE WHEN degrees(atan2(-e, s)) < 0 THEN degrees(atan2(-e, s)) + 360 ELSE degrees(atan2(-e, s)) END, 4) AS aspect FROM s WHERE e IS NOT NULL AND s IS NOT NULL"
)
def terrain_slope(spark, sf_dir):
    cells = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("col"), F.floor(F.col("p_partkey") / 50).alias("row"), F.col("p_retailprice").alias("value"))
    return raster.terrain(cells).select("col", "row", F.round("slope", 5).alias("slope"), F.round("aspect", 4).alias("aspect"))


@query(
    "WITH z AS (SELECT c_custkey AS zone, c_custkey % 40 + 0.25 AS x0, c_custkey % 30 + 0.5 AS y0, c_custkey % 40 + 2.75 AS x1, c_custkey % 30 + 1.75 AS y1 FROM customer), "
    "g AS (SELECT DISTINCT p_partkey % 50 AS col, (p_partkey // 50) % 40 AS row FROM part) "
    "SELECT zone, col, row, round((least(x1, col + 1) - greatest(x0, col)) * (least(y1, row + 1) - greatest(y0, row)), 6) AS coverage FROM z JOIN g ON x0 < col + 1 AND x1 > col AND y0 < row + 1 AND y1 > row"
)
def zonal_overlay(spark, sf_dir):
    key = F.col("c_custkey")
    corners = ((key % 40 + 0.25).cast("double"), (key % 30 + 0.5).cast("double"), (key % 40 + 2.75).cast("double"), (key % 30 + 1.75).cast("double"))
    zones = table(spark, sf_dir, "customer").select(key.alias("zone"), geometry.rectangle(*corners).alias("geom"))
    cells = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("col"), (F.floor(F.col("p_partkey") / 50) % 40).alias("row")).distinct()
    return raster.overlay(zones, cells, tile=8).select("zone", "col", "row", F.round("coverage", 6).alias("coverage"))


@query(
    "WITH z AS (SELECT c_custkey AS zone, c_nationkey, c_custkey % 40 + 0.25 AS x0, c_custkey % 30 + 0.5 AS y0, c_custkey % 40 + 2.75 AS x1, c_custkey % 30 + 1.75 AS y1 FROM customer), "
    "g AS (SELECT p_partkey % 50 AS col, (p_partkey // 50) % 40 AS row, max(p_size) AS v FROM part GROUP BY 1, 2), "
    "o AS (SELECT zone, v, (least(x1, col + 1) - greatest(x0, col)) * (least(y1, row + 1) - greatest(y0, row)) AS w FROM z JOIN g ON x0 < col + 1 AND x1 > col AND y0 < row + 1 AND y1 > row), "
    "m AS (SELECT zone, round(CAST(sum(v * w) AS DOUBLE) / CAST(sum(w) AS DOUBLE), 6) AS soil_mean FROM o GROUP BY 1), t AS (SELECT zone, v, sum(w) AS w FROM o GROUP BY 1, 2), k AS (SELECT zone, max_by(v, w * 1000 + v) AS soil_mode FROM t GROUP BY 1) "
    "SELECT zone AS divide_id, c_nationkey, soil_mean, soil_mode, round(CAST((x0 + x1) / 2 AS DOUBLE), 6) AS x, round(CAST((y0 + y1) / 2 AS DOUBLE), 6) AS y FROM z LEFT JOIN m USING (zone) LEFT JOIN k USING (zone)"
)
def value_added_attributes(spark, sf_dir):
    key = F.col("c_custkey")
    corners = ((key % 40 + 0.25).cast("double"), (key % 30 + 0.5).cast("double"), (key % 40 + 2.75).cast("double"), (key % 30 + 1.75).cast("double"))
    divides = table(spark, sf_dir, "customer").select(key.alias("divide_id"), "c_nationkey", geometry.rectangle(*corners).alias("geom"))
    cells = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 50).alias("col"), (F.floor(F.col("p_partkey") / 50) % 40).alias("row")).agg(F.max("p_size").alias("value"))
    layers = {"divide-attributes": divides.select("divide_id", "c_nationkey")}
    layers = plan.add_zonal_attributes(layers, divides.select("divide_id", "geom"), cells, {"soil_mean": "mean", "soil_mode": "mode"}, tile=8)
    return layers["divide-attributes"].select("divide_id", "c_nationkey", F.round("soil_mean", 6).alias("soil_mean"), "soil_mode", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


# ---- geometry


@query(
    "WITH c AS (SELECT {A} AS a, {N} AS n, {C} AS c, {RHO0} AS rho0, {E2} AS e2), p AS (SELECT p_partkey, p_retailprice * 1000 - 1000000 AS x, p_size * 40000 + 300000 AS y FROM part), "
    "q AS (SELECT p_partkey, atan2(x, rho0 - y) AS theta, (c - pow(sqrt(x * x + pow(rho0 - y, 2)) * n / a, 2)) / n AS q, n, e2 FROM p, c), "
    .replace("{A}", repr(geometry._A)).replace("{N}", repr(geometry._N)).replace("{C}", repr(geometry._C)).replace("{RHO0}", repr(geometry._RHO0)).replace("{E2}", repr(geometry._E2))
    + "f0 AS (SELECT *, asin(q / 2) AS phi FROM q)"
    + "".join(
        f", f{k} AS (SELECT p_partkey, theta, q, n, e2, phi + pow(1 - e2 * pow(sin(phi), 2), 2) / (2 * cos(phi)) * (q / (1 - e2) - sin(phi) / (1 - e2 * pow(sin(phi), 2)) + ln((1 - sqrt(e2) * sin(phi)) / (1 + sqrt(e2) * sin(phi))) / (2 * sqrt(e2))) AS phi FROM f{k - 1})"
        for k in range(1, 11)
    )
    + " SELECT p_partkey, round(degrees(theta / n) - 96, 6) AS lon, round(degrees(phi), 6) AS lat FROM f10"
)
def albers_inverse(spark, sf_dir):
    at = geometry.albers_inverse(F.col("p_retailprice") * 1000 - 1000000, (F.col("p_size") * 40000 + 300000).cast("double"))
    return table(spark, sf_dir, "part").select("p_partkey", at.alias("at")).select("p_partkey", F.round("at.lon", 6).alias("lon"), F.round("at.lat", 6).alias("lat"))


@query("SELECT c_custkey, c_acctbal AS minx, CAST(c_nationkey AS DOUBLE) AS miny, c_acctbal AS maxx, CAST(c_nationkey AS DOUBLE) AS maxy FROM customer")
def wkb_point_bbox(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select("c_custkey", geometry.point("c_acctbal", F.col("c_nationkey").cast("double")).alias("geom"))
    return points.select("c_custkey", geometry.bounds("geom").alias("box")).select("c_custkey", "box.*")


@query("SELECT c_mktsegment, count(*) AS features, min(c_acctbal) AS minx, CAST(min(c_nationkey) AS DOUBLE) AS miny, max(c_acctbal) AS maxx, CAST(max(c_nationkey) AS DOUBLE) AS maxy FROM customer GROUP BY 1")
def layer_extent(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select("c_mktsegment", geometry.bounds(geometry.point("c_acctbal", F.col("c_nationkey").cast("double"))).alias("box"))
    return points.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("features"), *aggregates.extent("box"))


@query("SELECT c_custkey, true AS same, CAST(61 AS INT) AS bytes FROM customer")
def gpkg_blob_roundtrip(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select("c_custkey", geometry.point("c_acctbal", F.col("c_nationkey").cast("double")).alias("geom"))
    blobs = points.withColumn("blob", geometry.to_blob("geom"))
    return blobs.select("c_custkey", (geometry.from_blob(F.col("blob")) == F.col("geom")).alias("same"), F.length("blob").alias("bytes"))


@query("SELECT n_nationkey, '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || n_nationkey || '.0,' || n_regionkey || '.5]},\"properties\":{\"n_name\":\"' || n_name || '\"}}' AS feature FROM nation")
def geojson_features(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    shape = geometry.geojson(geometry.point(F.col("n_nationkey").cast("double"), F.col("n_regionkey") + F.lit(0.5)), project=False)
    rows = nation.select("n_nationkey", "n_name", shape.alias("s")).where("s.json IS NOT NULL")
    return rows.select("n_nationkey", F.concat(F.lit('{"type":"Feature","geometry":'), F.col("s.json"), F.lit(',"properties":'), F.to_json(F.struct("n_name")), F.lit("}")).alias("feature"))


@query("SELECT c_custkey, round(c_custkey % 40 + 1.5, 6) AS x, round(c_custkey % 30 + 1.0, 6) AS y FROM customer")
def polygon_centroid(spark, sf_dir):
    key = F.col("c_custkey")
    zones = table(spark, sf_dir, "customer").select("c_custkey", geometry.rectangle((key % 40 + 0.5).cast("double"), (key % 30).cast("double"), (key % 40 + 2.5).cast("double"), (key % 30 + 2).cast("double")).alias("geom"))
    return zones.select("c_custkey", geometry.centroid("geom").alias("at")).select("c_custkey", F.round("at.x", 6).alias("x"), F.round("at.y", 6).alias("y"))


@query(SQL["albers_inverse"])
def centroid_lon_lat(spark, sf_dir):
    x, y = F.col("p_retailprice") * 1000 - 1000000, (F.col("p_size") * 40000 + 300000).cast("double")
    at = table(spark, sf_dir, "part").select("p_partkey", geometry.centroid(geometry.rectangle(x - 500, y - 300, x + 500, y + 300)).alias("c"))
    at = at.select("p_partkey", geometry.albers_inverse(F.col("c.x"), F.col("c.y")).alias("at"))
    return at.select("p_partkey", F.round("at.lon", 6).alias("lon"), F.round("at.lat", 6).alias("lat"))


@query(
    "SELECT p_partkey AS n, true AS same, CAST(133 AS INT) AS bytes, '{\"type\":\"Polygon\",\"coordinates\":[[' || concat_ws(',', a, b, c, d, a) || ']]}' AS json FROM (SELECT p_partkey, "
    + ", ".join(f"'[' || (p_partkey % 40 + {i}) || '.0,' || (p_partkey // 40 + {j}) || '.0]' AS {k}" for k, i, j in (("a", 0, 0), ("b", 1, 0), ("c", 1, 1), ("d", 0, 1)))
    + " FROM part)"
)
def polygon_formats(spark, sf_dir):
    shapes = _squares(spark, sf_dir).select("n", "geom", geometry.to_blob("geom").alias("blob"), geometry.geojson(F.col("geom"), project=False)["json"].alias("json"))
    return shapes.select("n", (geometry.from_blob(F.col("blob")) == F.col("geom")).alias("same"), F.length("blob").alias("bytes"), "json")


@query("SELECT (SELECT arg_min(CAST(n_nationkey AS VARCHAR), n_nationkey) FROM nation) AS n_nationkey, (SELECT count(*) FROM part) AS catchments, (SELECT count(*) FROM orders) AS flowpaths")
def viewer_metadata(spark, sf_dir):
    vpuid = relational.first_value(table(spark, sf_dir, "nation"), "n_nationkey", "n_nationkey")
    counts = [table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias(c)) for t, c in (("part", "catchments"), ("orders", "flowpaths"))]
    return vpuid.join(counts[0]).join(counts[1])  # three tables of one row


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) % 5 IN (1, 3, 4) AS kept FROM events")
def edges_from_json(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), (k % 5).isin(1, 3, 4).alias("kept"))


@query(
    "SELECT CAST(p_size % 3 AS BIGINT) AS ft, p_partkey AS fn, p_partkey % 5 AS tt, p_partkey // 2 AS tn FROM part WHERE p_partkey >= 1"
)
def edges_from_files(spark, sf_dir):
    path = fresh_path(spark, "edges")
    graph_json = F.to_json(F.struct(F.struct(F.lit(1).alias("total_edges")).alias("meta"), F.array(F.array("ft", "fn", "tt", "tn")).alias("edges")))
    _edges(spark, sf_dir).select(graph_json).write.text(path)
    return read_edges(spark, path).drop("pos")


# ---- display


@query(
    "SELECT p_partkey, round(CASE WHEN p_size < 10 THEN 1.0 WHEN p_size < 30 THEN 1 + 4.0 * (p_size - 10) / 20 WHEN p_size < 50 THEN 5 + 15.0 * (p_size - 30) / 20 ELSE 20 END, 6) AS width, "
    "round(CASE WHEN p_size < 10 THEN 1.0 WHEN p_size < 20 THEN 1 + 7 * (pow(1.5, p_size - 10) - 1) / (pow(1.5, 10) - 1) ELSE 8 END, 6) AS grown, CASE WHEN p_size >= 40 THEN 'c' WHEN p_size >= 20 THEN 'b' ELSE 'a' END AS step FROM part"
)
def style_interpolate(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(display.interpolate(size, [(10, 1), (30, 5), (50, 20)]), 6).alias("width"),
        F.round(display.interpolate(size, [(10, 1), (20, 8)], 1.5), 6).alias("grown"),
        display.step(size, "a", [(20, "b"), (40, "c")]).alias("step"),
    )


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS status, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'third' END, 'none') AS label FROM orders")
def style_match_case(spark, sf_dir):
    label = F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.lit("third")), F.lit("none"))
    return table(spark, sf_dir, "orders").select("o_orderkey", display.match(F.col("o_orderstatus"), {"F": "done", "O": "open"}, "other").alias("status"), label.alias("label"))


@query("SELECT p_partkey FROM part WHERE p_size >= 10 AND (p_brand IN ('Brand#11', 'Brand#12', 'Brand#23') OR NOT p_size < 30) AND p_size <> 33 AND p_type IS NOT NULL")
def style_filter(spark, sf_dir):
    rule = ["all", [">=", "p_size", 10], ["any", ["in", "p_brand", "Brand#11", "Brand#12", "Brand#23"], ["!", ["<", "p_size", 30]]], ["!=", "p_size", 33], ["has", "p_type"]]
    return table(spark, sf_dir, "part").where(display.feature_filter(rule)).select("p_partkey")


@query(
    "SELECT p_partkey, CASE WHEN p_size IN (1, 2, 3) THEN 'low' WHEN p_size = 50 THEN 'top' ELSE 'mid' END AS matched, "
    "CASE WHEN p_brand IN ('Brand#11', 'Brand#23') THEN p_size + 0.5 WHEN p_size > 40 THEN 2 ELSE 0 END AS chosen, "
    "coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_brand END, p_type) || chr(10) || p_size AS label, "
    "CASE WHEN p_size >= 20 THEN 'b' ELSE 'a' END AS step, round(CASE WHEN 12 >= p_size * 2 - 10 THEN 1 ELSE 0 END * 1.0, 1) AS near FROM part"
)
def style_expressions(spark, sf_dir):
    size, brand = ["get", "p_size"], ["get", "p_brand"]
    rows = table(spark, sf_dir, "part").withColumn("third", F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")))
    rules = {
        "matched": ["match", size, [1, 2, 3], "low", 50, "top", "mid"],
        "chosen": ["case", ["in", brand, ["literal", ["Brand#11", "Brand#23"]]], ["+", size, 0.5], [">", size, 40], 2.0, 0.0],
        "label": ["format", ["coalesce", ["get", "third"], ["get", "p_type"]], {}, "\n", {}, size, {}],
        "step": ["step", size, "a", 20, "b"],
        "near": ["case", [">=", ["zoom"], ["-", ["*", size, 2], 10]], 1.0, 0.0],
    }
    return rows.select("p_partkey", *[display.expression(rule, zoom=12).alias(name) for name, rule in rules.items()])


@query("SELECT p_partkey FROM part WHERE (p_brand = 'Brand#12' OR NOT p_size > 10) AND CASE WHEN p_partkey % 2 = 0 THEN 'Polygon' ELSE 'Point' END = 'Polygon' AND 20 >= p_size + 1 AND (p_partkey % 5 = 0 OR 20 < p_size + 8)")
def style_filter_by_zoom(spark, sf_dir):
    rule = ["all", ["any", ["==", ["get", "p_brand"], "Brand#12"], ["!", [">", "p_size", 10]]], ["==", ["geometry-type"], "Polygon"], [">=", ["zoom"], ["+", ["get", "p_size"], 1]]]
    shape = F.when(F.col("p_partkey") % 2 == 0, F.lit("Polygon")).otherwise(F.lit("Point"))
    rows = table(spark, sf_dir, "part").where(display.feature_filter(rule, 20, shape))
    most = F.when(F.col("p_partkey") % 5 != 0, F.col("p_size") + 8)
    return rows.where(display.visible(20, F.col("p_size"), most)).select("p_partkey")


_ALONG = "least(greatest((p_size - 10) / 20.0, 0), 1)"


@query(
    f"WITH a AS (SELECT *, {_ALONG} AS k, 1 - 0.5 * {_ALONG} AS a FROM part) SELECT p_partkey, round(255 * (1 - k) / a, 4) AS fill_r, round(0.5 * 255 * k / a, 4) AS fill_b, round(a, 4) AS fill_a, "
    "CASE p_brand WHEN 'Brand#11' THEN 'rgba(0,119,187,1.000)' WHEN 'Brand#12' THEN 'rgba(136,153,170,1.000)' ELSE 'rgba(1,2,3,0.500)' END AS stroke, "
    "round(1 + 4 * (pow(1.5, least(greatest(p_size - 10, 0), 20)) - 1) / (pow(1.5, 20) - 1), 6) AS width, 1 + 3.0 / 4 AS opacity, "
    "round(CASE WHEN p_size > 25 THEN 8 ELSE 4 END * 0.25 + CASE WHEN p_size >= 20 THEN 20 ELSE 10 END * 0.75, 4) AS text_size, p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 AS simple FROM a"
)
def style_colours(spark, sf_dir):
    size, brand = ["get", "p_size"], ["get", "p_brand"]
    name = F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, F.lit("\u05d0")).when(F.col("p_partkey") % 5 == 0, F.lit("\u0915")).otherwise(""))
    rules = {
        "fill": ["interpolate", ["linear"], size, 10, "#f00", 30, ["rgba", 0, 0, 255, 0.5]],
        "stroke": ["match", brand, "Brand#11", ["rgba", 0, 119, 187, 1], "Brand#12", "#8899aa", "rgba(1, 2, 3, 0.5)"],
        "width": {"stops": [[10, 1], [30, 5]], "base": 1.5, "property": "p_size"},
        "opacity": {"stops": [[10, 1], [14, 2]]},
        "text_size": ["interpolate", ["linear"], ["zoom"], 10, ["case", [">", size, 25], 8, 4], 14, ["step", size, 10, 20, 20]],
        "simple": ["is-supported-script", ["get", "name"]],
    }
    drawn = table(spark, sf_dir, "part").withColumn("name", name).select("p_partkey", *[display.expression(rule, zoom=13).alias(k) for k, rule in rules.items()])
    parts = [F.round(F.col("fill")[k], 4).alias(f"fill_{k}") for k in "rba"]
    return drawn.select("p_partkey", *parts, display.colour_text(F.col("stroke")).alias("stroke"), F.round("width", 6).alias("width"), "opacity", "text_size", "simple")


@query(
    "SELECT n_nationkey, array_to_string(list_transform(string_split(n_name || 'é€łž', ''), lambda c: printf('%02X', unicode(c) & 255)), '') AS low, format('{:,}', n_nationkey * 123457) AS grouped, "
    "printf('%.2f', n_nationkey / 3.0) AS fixed, strftime(make_timestamp((n_nationkey * 86461000007) * 1000), '%Y%m%dT%H%M%SZ') AS stamp, strftime(make_timestamp((n_nationkey * 86461000007) * 1000), '%Y%m%d') AS day FROM nation"
)
def text_formats(spark, sf_dir):
    key = F.col("n_nationkey").cast("bigint")
    stamp = compact_time(F.timestamp_millis(key * 86461000007))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.hex(low_bytes(F.concat("n_name", F.lit("é€łž")))).alias("low"),
        grouped(key * 123457).alias("grouped"),
        fixed(key / 3, 2).alias("fixed"),
        stamp.alias("stamp"),
        F.substring(stamp, 1, 8).alias("day"),
    )


@query("SELECT (SELECT CAST(min_by(r_name, r_regionkey) AS VARCHAR) FROM region) AS named, (SELECT CAST(arg_min(c_mktsegment, c_custkey) AS VARCHAR) FROM customer) AS sixth, NULL AS neither".replace("NULL", "CAST(NULL AS VARCHAR)"))
def region_lookup(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    sixth = customer.select("c_custkey", *[F.lit(k).alias(f"x{k}") for k in range(4)], "c_mktsegment")
    region = table(spark, sf_dir, "region").withColumn("vpuid", F.col("r_name"))
    found = [relational.region_of(region, "r_regionkey"), relational.region_of(sixth, "c_custkey"), relational.region_of(table(spark, sf_dir, "region").select("r_regionkey"), "r_regionkey")]
    # three tables of one row each
    named = [f.select(F.lit(n).alias("n"), "region") for f, n in zip(found, ("named", "sixth", "neither"))]
    return reduce(DataFrame.unionByName, named).groupBy().pivot("n", ["named", "sixth", "neither"]).agg(F.max("region"))


# ---- pointer files


@query(
    "WITH t AS (SELECT doc_id, 'frozen: true' || chr(10) || 'md5: a' || chr(10) || (CASE WHEN doc_id % 3 = 0 THEN 'outs:' || chr(10) ELSE '' END) || '  md5: b' || chr(10) || 'size: 3' || chr(10) || coalesce(text, '') AS x FROM documents), "
    "l AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS line, generate_subscripts(string_split(x, chr(10)), 1) AS i FROM t), "
    "f AS (SELECT *, coalesce(max(CASE WHEN regexp_matches(line, '^outs:') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS after FROM l) "
    "SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY i)) AS cleaned FROM f WHERE NOT regexp_matches(line, '^\\s*frozen:\\s*true\\s*$') AND NOT (after = 1 AND regexp_matches(line, '^\\s*(md5|size):')) GROUP BY 1"
)
def pointer_clean(spark, sf_dir):
    outs = F.when(F.col("doc_id") % 3 == 0, F.lit("outs:\n")).otherwise(F.lit(""))
    text = F.concat(F.lit("frozen: true\nmd5: a\n"), outs, F.lit("  md5: b\nsize: 3\n"), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(pointers.cleaned(text)).alias("cleaned"))


@query("SELECT 'd' || (doc_id % 7) AS folder, count(*) FILTER (doc_id % 3 = 0) AS modified, count(*) FILTER (doc_id % 3 <> 0) AS unchanged FROM documents GROUP BY 1")
def pointer_tallies(spark, sf_dir):
    path = F.concat(F.lit("d"), (F.col("doc_id") % 7).cast("string"), F.lit("/f"))
    text = F.when(F.col("doc_id") % 3 == 0, F.lit("outs:\n- md5: x\n  md5: y")).otherwise(F.lit("deps:\n  md5: z"))
    return pointers.tallies(table(spark, sf_dir, "documents").select(path.alias("path"), text.alias("text")))


@query(
    "SELECT 'p' || p_partkey || '.dvc' AS name, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS removed, 'deps:' || chr(10) || '  md5: ' || p_name || chr(10) || 'outs:' || chr(10) || '- path: ' || p_type AS text FROM part"
)
def pointers_written_back(spark, sf_dir):
    """Pointer files of the parts, cleaned where they lie and read again."""
    folder = fresh_path(spark, "pointers")
    text = F.concat(F.lit("deps:\n  md5: "), "p_name", F.when(F.col("p_partkey") % 3 == 0, F.lit("\nfrozen: true")).otherwise(""), F.lit("\nouts:\n  md5: "), "p_brand", F.lit("\n- path: "), "p_type")
    # a folder for each thousand keys, as one of all files would be listed by one task
    path = F.concat(F.lit(f"{folder}/"), F.floor(F.col("p_partkey") / 1000), F.lit("/p"), "p_partkey", F.lit(".dvc"))
    parts = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type"), FILES)
    write_texts(parts.select(path.alias("path"), text.alias("text"))).write.format("noop").mode("overwrite").save()
    last = F.element_at(F.split("path", "/"), -1).alias("name")
    before = staged(pointers.rewritten(read_texts(spark, folder, "*.dvc")), "rewritten")
    write_texts(before).write.format("noop").mode("overwrite").save()
    return read_texts(spark, folder, "*.dvc").select(last, "text").join(by_key(before.select(last, F.size("removed").alias("removed"))), "name")


@query(
    "SELECT doc_id % 1000 AS k, count(*) AS files, sum(CASE WHEN doc_id % 3 = 0 THEN 3 ELSE 1 END) AS removed, CASE WHEN doc_id % 1000 % 2 = 0 THEN 'even' ELSE 'odd' END AS kind "
    "FROM documents WHERE doc_id % 5 <> 0 GROUP BY 1"
)
def pointer_rewrites(spark, sf_dir):
    key = F.col("doc_id")
    lines = F.when(key % 5 == 0, F.lit("deps:\n  md5: a")).when(key % 3 == 0, F.lit("frozen: true  \nouts:\n- md5: x\n  md5: y\n  size: 3")).otherwise(F.lit("md5: a\n frozen: true\nouts:"))
    found = pointers.rewritten(table(spark, sf_dir, "documents").select(key.cast("string").alias("path"), lines.alias("text")))
    k = (F.col("path").cast("bigint") % 1000).alias("k")
    counts = found.groupBy(k).agg(F.count("*").alias("files"), F.sum(F.size("removed")).alias("removed"))
    return counts.withColumn("kind", F.when(F.col("k") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")))


@query("SELECT 'o/' || o_orderkey AS path, 'm' || o_orderkey AS md5, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 9 END AS size, o_orderkey % 2 = 0 AND (o_orderkey % 4 = 0 OR o_orderkey % 9 = o_orderkey % 7) AS there FROM orders")
def tracked_objects(spark, sf_dir):
    key = F.col("o_orderkey")
    size = F.when(key % 4 != 0, F.concat(F.lit("  size: "), (key % 9).cast("string"))).otherwise(F.lit("  desc: x"))
    files = table(spark, sf_dir, "orders").select(F.concat(F.lit("outs:\n- md5: m"), key.cast("string"), F.lit("\n"), size, F.lit("\n  path: o/"), key.cast("string")).alias("text"))
    listing = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.concat(F.lit("o/"), key.cast("string")).alias("path"), (key % 7).cast("bigint").alias("size"))
    return pointers.present(files, listing)


# ---- network steps


def _lines(spark, sf_dir):
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(key.alias("n"), F.when(key >= 1, F.floor(key / 2)).alias("to"), (F.col("p_size") * 100.0).alias("length"), (key % 9 + 1).alias("area"))


_LINES = "t AS (SELECT p_partkey AS n, CASE WHEN p_partkey >= 1 THEN p_partkey // 2 END AS o, p_size * 100.0 AS length, p_partkey % 9 + 1 AS area FROM part)"


@query(
    f"WITH {_LINES}, p AS (SELECT n, o, length, CAST(greatest(ceil(length / 1500), 1) AS BIGINT) AS parts FROM t), x AS (SELECT *, unnest(range(1, parts + 1)) AS part FROM p) "
    "SELECT n, part, parts, round(length / parts, 6) AS length, CASE WHEN part = parts THEN o ELSE n END AS \"to\", CASE WHEN part < parts THEN part + 1 WHEN o IS NOT NULL THEN 1 END AS to_part FROM x"
)
def split_long_lines(spark, sf_dir):
    return network.split_long_lines(_lines(spark, sf_dir), 1500.0).withColumn("length", F.round("length", 6))


@query(
    f"WITH RECURSIVE {_LINES}, d(n, z) AS (SELECT n, n FROM t UNION ALL SELECT d.n, t.o FROM d JOIN t ON t.n = d.z WHERE t.length < 1000 AND t.o IS NOT NULL), "
    "f AS (SELECT d.n, d.z FROM d JOIN t ON t.n = d.z WHERE t.length >= 1000 OR t.o IS NULL), s AS (SELECT f.z, sum(t.area) AS area, count(*) AS members FROM f JOIN t ON t.n = f.n GROUP BY 1) "
    'SELECT t.n, g.z AS "to", round(t.length, 6) AS length, CAST(s.area AS BIGINT) AS area, s.members FROM t JOIN s ON s.z = t.n LEFT JOIN f g ON g.n = t.o'
)
def collapse_short_lines(spark, sf_dir):
    return network.collapse_short_lines(_lines(spark, sf_dir), 1000.0).withColumn("length", F.round("length", 6))


_TOTAL = f"{_LINES}, a(n, up) AS (SELECT n, n FROM t UNION ALL SELECT t.o, a.up FROM a JOIN t ON t.n = a.n WHERE t.o IS NOT NULL), w AS (SELECT a.n, CAST(sum(t.area) AS BIGINT) AS total FROM a JOIN t ON t.n = a.up GROUP BY 1)"


@query(f'WITH RECURSIVE {_TOTAL} SELECT t.n, t.o AS "to", t.area, w.total FROM t JOIN w ON w.n = t.n')
def total_drainage(spark, sf_dir):
    return network.total_drainage(_lines(spark, sf_dir))


def _open_lines(spark, sf_dir):
    """Lines that flow 17 numbers on, the last of them out of the table, and a cycle of 0, 1 and 2."""
    key = F.col("p_partkey")
    to = F.when(key == 0, 1).when(key == 1, 2).when(key == 2, 0).otherwise(key + 17)
    return table(spark, sf_dir, "part").select(key.alias("n"), to.alias("to"), F.when(key > 2, F.col("p_size") * 100.0).otherwise(0.0).alias("length"), (key % 9 + 1).alias("area"))


# the cycle ends on its smallest number, and a target that is not there is none
_OPEN = (
    "p AS (SELECT p_partkey AS n, CASE p_partkey WHEN 0 THEN NULL WHEN 1 THEN 2 WHEN 2 THEN 0 ELSE p_partkey + 17 END AS o, CASE WHEN p_partkey > 2 THEN p_size * 100.0 ELSE 0.0 END AS length, p_partkey % 9 + 1 AS area FROM part), "
    "t AS (SELECT p.n, q.n AS o, p.length, p.area FROM p LEFT JOIN p q ON q.n = p.o)"
)


@query(
    f"WITH RECURSIVE {_OPEN}, d(n, z) AS (SELECT n, n FROM t UNION ALL SELECT d.n, t.o FROM d JOIN t ON t.n = d.z WHERE t.length < 1000 AND t.o IS NOT NULL), "
    "f AS (SELECT d.n, d.z FROM d JOIN t ON t.n = d.z WHERE t.length >= 1000 OR t.o IS NULL), s AS (SELECT f.z, sum(t.area) AS area, count(*) AS members FROM f JOIN t ON t.n = f.n GROUP BY 1) "
    'SELECT t.n, g.z AS "to", round(t.length, 6) AS length, CAST(s.area AS BIGINT) AS area, s.members FROM t JOIN s ON s.z = t.n LEFT JOIN f g ON g.n = t.o'
)
def collapse_open_lines(spark, sf_dir):
    return network.collapse_short_lines(_open_lines(spark, sf_dir), 1000.0).withColumn("length", F.round("length", 6))


@query(
    f"WITH RECURSIVE {_OPEN}, a(n, up) AS (SELECT n, n FROM t UNION ALL SELECT t.o, a.up FROM a JOIN t ON t.n = a.n WHERE t.o IS NOT NULL), w AS (SELECT a.n, CAST(sum(t.area) AS BIGINT) AS total FROM a JOIN t ON t.n = a.up GROUP BY 1) "
    'SELECT t.n, t.o AS "to", t.area, w.total FROM t JOIN w ON w.n = t.n'
)
def total_drainage_open(spark, sf_dir):
    return network.total_drainage(_open_lines(spark, sf_dir))


@query(
    f"WITH RECURSIVE {_TOTAL}, i AS (SELECT t.o AS n, max(w.total // 50) AS passed FROM t JOIN w ON w.n = t.n WHERE t.o IS NOT NULL GROUP BY 1), "
    "m AS (SELECT t.n, t.o, t.area, (w.total // 50 <= coalesce(i.passed, 0)) AND t.o IS NOT NULL AS moves FROM t JOIN w ON w.n = t.n LEFT JOIN i ON i.n = t.n), "
    "d(n, z) AS (SELECT n, n FROM m UNION ALL SELECT d.n, m.o FROM d JOIN m ON m.n = d.z WHERE m.moves), f AS (SELECT d.n, d.z FROM d JOIN m ON m.n = d.z WHERE NOT m.moves), "
    "u AS (SELECT f.z AS n, any_value(g.z) AS o, sum(m.area) AS area, count(*) AS members FROM f JOIN m ON m.n = f.n JOIN m k ON k.n = f.z LEFT JOIN f g ON g.n = k.o GROUP BY 1), "
    "e(n, z) AS (SELECT n, n FROM u UNION ALL SELECT e.n, u.o FROM e JOIN u ON u.n = e.z WHERE u.area < 40 AND u.o IS NOT NULL), h AS (SELECT e.n, e.z FROM e JOIN u ON u.n = e.z WHERE u.area >= 40 OR u.o IS NULL) "
    "SELECT h.z AS unit, any_value(g.z) AS to_unit, CAST(sum(u.area) AS BIGINT) AS area, CAST(sum(u.members) AS BIGINT) AS members FROM h JOIN u ON u.n = h.n JOIN u k ON k.n = h.z LEFT JOIN h g ON g.n = k.o GROUP BY 1"
)
def aggregate_to_size(spark, sf_dir):
    return network.aggregate_to_size(_lines(spark, sf_dir), 50, 40)


@query(
    f"WITH RECURSIVE {_LINES}, d(n, z) AS (SELECT n, n FROM t UNION ALL SELECT d.n, t.o FROM d JOIN t ON t.n = d.z WHERE d.z % 11 <> 0 AND t.o IS NOT NULL), f AS (SELECT d.n, d.z FROM d JOIN t ON t.n = d.z WHERE d.z % 11 = 0 OR t.o IS NULL) "
    "SELECT f.z AS unit, any_value(g.z) AS to_unit, CAST(sum(t.area) AS BIGINT) AS area, count(*) AS members FROM f JOIN t ON t.n = f.n JOIN t k ON k.n = f.z LEFT JOIN f g ON g.n = k.o GROUP BY 1"
)
def aggregate_to_outlets(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return network.aggregate_to_outlets(lines, lines.where("n % 11 = 0").select("n"))




# ---- attributes and whole steps


@query(
    "WITH c AS (SELECT l_partkey AS d, CASE l_linenumber % 3 WHEN 0 THEN 'soil' WHEN 1 THEN 'vegetation' ELSE 'impervious' END AS name, floor(l_quantity) AS v, l_linenumber AS w FROM lineitem), "
    "t AS (SELECT d, name, v, sum(w) AS w FROM c GROUP BY 1, 2, 3), m AS (SELECT d, name, max_by(v, w * 1000 + v) AS v FROM t GROUP BY 1, 2), "
    "i AS (SELECT d, round(sum(v * w) / sum(w), 6) AS v FROM c WHERE name = 'impervious' GROUP BY 1), k AS (SELECT DISTINCT d FROM c) "
    'SELECT k.d AS divide_id, s.v AS "mode.soil", g.v AS "mode.vegetation", i.v AS "mean.impervious" FROM k LEFT JOIN (FROM m WHERE name = \'soil\') s ON s.d = k.d '
    "LEFT JOIN (FROM m WHERE name = 'vegetation') g ON g.d = k.d LEFT JOIN i ON i.d = k.d"
)
def minimal_attributes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    name = F.element_at(F.array(F.lit("soil"), F.lit("vegetation"), F.lit("impervious")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    covered = lines.select(F.col("l_partkey").alias("divide_id"), name.alias("name"), F.floor("l_quantity").cast("double").alias("value"), F.col("l_linenumber").alias("coverage"))
    walk = lines.select(F.col("l_orderkey").cast("string").alias("reference_id"), F.col("l_partkey").alias("divide_id"))
    basins = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ComID"), F.lit(1.0).alias("Coeff"), F.lit(1.0).alias("Area_sqkm"), F.lit(1.0).alias("Zmax"), F.lit(1.0).alias("Expon"))
    found = attributes.minimal_divide_attributes(covered, walk, basins)
    return found.select("divide_id", "`mode.soil`", "`mode.vegetation`", F.round("`mean.impervious`", 6).alias("mean.impervious"))


@query(
    "WITH c AS (SELECT l_partkey AS d, CASE l_linenumber % 3 WHEN 0 THEN 'soil' WHEN 1 THEN 'vegetation' ELSE 'impervious' END AS name, floor(l_quantity) AS v, l_linenumber AS w FROM lineitem), "
    "t AS (SELECT d, name, v, sum(w) AS w FROM c GROUP BY 1, 2, 3), m AS (SELECT d, name, max_by(v, w * 1000 + v) AS v FROM t GROUP BY 1, 2), i AS (SELECT d, round(sum(v * w) / sum(w), 6) AS v FROM c WHERE name = 'impervious' GROUP BY 1), "
    "b AS (SELECT l_partkey AS d, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 50 END AS coeff, o_orderkey % 9 AS area, o_custkey % 70 AS z, o_orderkey % 5 AS e FROM orders JOIN lineitem ON l_orderkey = o_orderkey), "
    "g AS (SELECT d, round(sum(coeff * area) / nullif(sum(area) FILTER (coeff IS NOT NULL), 0), 6) AS c, round(sum(z * area) / nullif(sum(area), 0), 6) AS z FROM b GROUP BY 1), e AS (SELECT d, max_by(e, n * 10 + e) AS e FROM (SELECT d, e, count(*) AS n FROM b GROUP BY 1, 2) GROUP BY 1) "
    'SELECT g.d AS divide_id, s.v AS "mode.soil", v.v AS "mode.vegetation", i.v AS "mean.impervious", g.c AS "mean.Coeff", g.z AS "mean.Zmax", CAST(e.e AS DOUBLE) AS "mode.Expon" FROM g JOIN e ON e.d = g.d '
    "LEFT JOIN (FROM m WHERE name = 'soil') s ON s.d = g.d LEFT JOIN (FROM m WHERE name = 'vegetation') v ON v.d = g.d LEFT JOIN i ON i.d = g.d"
)
def minimal_attributes_all(spark, sf_dir):
    lines, key, customer = table(spark, sf_dir, "lineitem"), F.col("o_orderkey"), F.col("o_custkey")
    name = F.element_at(F.array(F.lit("soil"), F.lit("vegetation"), F.lit("impervious")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    covered = lines.select(F.col("l_partkey").alias("divide_id"), name.alias("name"), F.floor("l_quantity").cast("double").alias("value"), F.col("l_linenumber").alias("coverage"))
    walk = lines.select(F.col("l_orderkey").cast("string").alias("reference_id"), F.col("l_partkey").alias("divide_id"))
    numbers = {"Coeff": F.when(key % 7 != 0, customer % 50), "Area_sqkm": key % 9, "Zmax": customer % 70, "Expon": key % 5 + 0.5}
    basins = table(spark, sf_dir, "orders").select(key.alias("ComID"), *[c.cast("double").alias(n) for n, c in numbers.items()])
    found = attributes.minimal_divide_attributes(covered, walk, basins)
    rounded = {c: F.round(f"`{c}`", 6) for c in ("mean.impervious", "mean.Coeff", "mean.Zmax")} | {"mode.Expon": F.col("`mode.Expon`").cast("double")}
    return found.select("divide_id", *[rounded.get(c, F.col(f"`{c}`")).alias(c) for c in found.columns if c != "divide_id"])


@query(
    "WITH c AS (SELECT l_partkey AS d, l_linenumber AS k, CASE WHEN l_suppkey % 2 = 0 THEN 'bexp' ELSE 'smcmax' END AS name, floor(l_quantity) AS v, l_linenumber AS w FROM lineitem), "
    "t AS (SELECT d, k, v, sum(w) AS w FROM c WHERE name = 'bexp' GROUP BY 1, 2, 3), m AS (SELECT d, k, max_by(v, w * 1000 + v) AS v FROM t GROUP BY 1, 2), a AS (SELECT d, k, round(avg(v), 6) AS v FROM c WHERE name = 'smcmax' GROUP BY 1, 2) "
    "SELECT d AS divide_id, " + ", ".join(f"any_value(v) FILTER (n = 'b{k}') AS \"mode.bexp_{k}\", any_value(v) FILTER (n = 's{k}') AS \"mean.smcmax_{k}\"" for k in range(1, 8))
    + " FROM (SELECT d, 'b' || k AS n, v FROM m UNION ALL SELECT d, 's' || k, v FROM a) GROUP BY 1"
)
def soil_attributes_all(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    name = F.when(F.col("l_suppkey") % 2 == 0, F.lit("bexp")).otherwise(F.lit("smcmax"))
    covered = lines.select(F.col("l_partkey").alias("divide_id"), name.alias("name"), F.col("l_linenumber").alias("layer"), F.floor("l_quantity").cast("double").alias("value"), F.col("l_linenumber").alias("coverage"))
    found = attributes.soils(covered, {"bexp": "mode", "smcmax": "mean"}, layers=range(1, 8))
    return found.select("divide_id", *[F.round(f"`{c}`", 6).alias(c) for c in found.columns if c != "divide_id"])


@query(
    "WITH c AS (SELECT l_partkey AS d, l_linenumber AS k, CASE WHEN l_suppkey % 2 = 0 THEN 'bexp' ELSE 'smcmax' END AS name, floor(l_quantity) AS v, l_linenumber AS w FROM lineitem WHERE l_linenumber <= 4), "
    "t AS (SELECT d, k, v, sum(w) AS w FROM c WHERE name = 'bexp' GROUP BY 1, 2, 3), m AS (SELECT d, k, max_by(v, w * 1000 + v) AS v FROM t GROUP BY 1, 2), a AS (SELECT d, k, round(avg(v), 6) AS v FROM c WHERE name = 'smcmax' GROUP BY 1, 2) "
    "SELECT d AS divide_id, " + ", ".join(f"any_value(v) FILTER (n = 'b{k}') AS \"mode.bexp_{k}\", any_value(v) FILTER (n = 's{k}') AS \"mean.smcmax_{k}\"" for k in (1, 2, 3, 4))
    + " FROM (SELECT d, 'b' || k AS n, v FROM m UNION ALL SELECT d, 's' || k, v FROM a) GROUP BY 1"
)
def soil_attributes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber <= 4")
    name = F.when(F.col("l_suppkey") % 2 == 0, F.lit("bexp")).otherwise(F.lit("smcmax"))
    covered = lines.select(F.col("l_partkey").alias("divide_id"), name.alias("name"), F.col("l_linenumber").alias("layer"), F.floor("l_quantity").cast("double").alias("value"), F.col("l_linenumber").alias("coverage"))
    found = attributes.soils(covered, {"bexp": "mode", "smcmax": "mean"})
    return found.select("divide_id", *[F.round(f"`{c}`", 6).alias(c) for c in found.columns if c != "divide_id"])


@query(
    f"WITH RECURSIVE {_LINES}, d(n, z) AS (SELECT n, n FROM t UNION ALL SELECT d.n, t.o FROM d JOIN t ON t.n = d.z WHERE d.z % 11 <> 0 AND t.o IS NOT NULL), f AS (SELECT d.n, d.z FROM d JOIN t ON t.n = d.z WHERE d.z % 11 = 0 OR t.o IS NULL) "
    "SELECT CAST(f.n AS VARCHAR) AS reference_id, 'fp-' || f.z AS flowpath_id, 'cat-' || f.z AS divide_id, 'fp-' || g.z AS flowpath_toid, t.area AS areasqkm FROM f JOIN t ON t.n = f.n JOIN t k ON k.n = f.z LEFT JOIN f g ON g.n = k.o"
)
def model_network(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    outlets = lines.where("n % 11 = 0").select("n")
    return network.model_network(lines, network.aggregate_to_outlets(lines, outlets), network.placed_at_outlets(lines, outlets))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (3, 7, 11) UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey < 600")
def read_by_ids(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    few, more = read_ids(spark, path, "o_orderkey", [3, 7, 11]), read_ids(spark, path, "o_orderkey", list(range(0, 600, 10)))
    return few.unionByName(more).select("o_orderkey", "o_totalprice")


@query("SELECT 'nation' AS table_name, 'attributes' AS data_type, count(*) AS feature_count, NULL::DOUBLE AS minx, NULL::DOUBLE AS maxy FROM nation UNION ALL SELECT 'customer', 'features', count(*), min(c_acctbal), CAST(max(c_nationkey) AS DOUBLE) FROM customer")
def container_catalog(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select("c_custkey", geometry.point("c_acctbal", F.col("c_nationkey").cast("double")).alias("geom"))
    return catalog({"nation": table(spark, sf_dir, "nation"), "customer": points}).select("table_name", "data_type", "feature_count", "minx", "maxy")


@query(
    "SELECT n_regionkey, '{\"type\":\"FeatureCollection\",\"features\":[' || string_agg('{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || n_nationkey || '.0,' || n_regionkey || '.5]},\"properties\":{\"n_name\":\"' || n_name || '\"}}', ',' ORDER BY n_nationkey) || ']}' AS collection, "
    "CAST(min(n_nationkey) AS DOUBLE) AS minx, CAST(max(n_nationkey) AS DOUBLE) AS maxx FROM nation GROUP BY 1"
)
def feature_collection(spark, sf_dir):
    place = geometry.point(F.col("n_nationkey").cast("double"), F.col("n_regionkey") + F.lit(0.5))
    keys = F.struct("n_regionkey", "n_nationkey").alias("keys")
    rows = table(spark, sf_dir, "nation").select("n_name", keys, place.alias("geom"))
    made = features.features(rows, keep=["keys"], project=False, names=["n_name"])
    found = features.collections(made.select("keys.*", "feature", "box"), "n_regionkey", "n_nationkey")
    return found.select("n_regionkey", "collection", "minx", "maxx")


@query(
    "SELECT s_suppkey, '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || s_nationkey || '.0,' || s_nationkey % 7 || '.5]},\"properties\":{\"s_suppkey\":' || s_suppkey || ',\"even\":' "
    "|| CASE WHEN s_suppkey % 2 = 0 THEN '2' ELSE 'null' END || ',\"raw\":null}}' AS feature, CAST(s_nationkey AS DOUBLE) AS minx FROM supplier WHERE s_suppkey % 3 <> 0"
)
def features_with_properties(spark, sf_dir):
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    place = F.when(key % 3 != 0, geometry.point(nation.cast("double"), nation % 7 + F.lit(0.5)))
    rows = table(spark, sf_dir, "supplier").select(key, F.when(key % 2 == 0, 2).alias("even"), F.col("s_name").cast("binary").alias("raw"), place.alias("geom"))
    return features.features(rows, keep=["s_suppkey"], project=False).select("s_suppkey", "feature", "box.minx")


@query(
    "SELECT 'cat-' || p_partkey AS divide_id, 'wb-' || p_partkey AS id, CASE WHEN p_partkey >= 1 THEN 'nex-' || CASE WHEN p_partkey % 10 = 0 THEN 7 ELSE p_partkey // 2 END END AS toid, '16' AS vpuid, "
    "CAST(p_size AS DOUBLE) AS lengthkm, p_partkey % 9 AS tot_drainage_areasqkm FROM part"
)
def preparation(spark, sf_dir):
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    fp, size = typed("fp", key), F.col("p_size").cast("double")
    layers = {
        "flowpaths": part.select(fp.alias("flowpath_id"), F.when(key >= 1, typed("nex", F.floor(key / 2))).alias("flowpath_toid"), F.lit("f").alias("flowline_id"), F.lit("m").alias("member_comid")),
        "network": part.select(fp.alias("flowpath_id"), typed("cat", key).alias("divide_id"), size.alias("flowpath_lengthkm"), (key % 9).alias("tot_drainage_areasqkm"), F.when(key % 4 == 0, key).alias("poi_id")),
        "divides": part.select(typed("cat", key).alias("divide_id"), fp.alias("flowpath_id")),
        "nexus": part.select(typed("nex", key).alias("nexus_id"), typed("fp", F.floor(key / 2)).alias("nexus_toid")),
    }
    patches = part.where("p_partkey % 10 = 0 AND p_partkey >= 1").select(fp.alias("id"), F.lit("nex-7").alias("flowpath_toid"), F.lit(1).alias("ord"))
    settings = plan.Settings()
    layers = plan.reconcile(plan.describe(plan.correct(layers, patches)), settings)
    return layers["divides"].select("divide_id", "id", "toid", "vpuid", "lengthkm", "tot_drainage_areasqkm")


# ---- geometry of the network steps


def _bent_lines(spark, sf_dir):
    """A line for each order, through its lineitems."""
    corner = F.struct("l_linenumber", (F.sqrt("l_extendedprice") * 300).alias("x"), (F.col("l_quantity") * 1000).alias("y"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("n")).agg(F.sort_array(F.collect_list(corner)).alias("v"))
    shaped = rows.select("n", F.when(F.col("n") > 1, F.floor(F.col("n") / 2)).alias("to"), geometry.line("v.x", "v.y").alias("geom"))
    return shaped.withColumn("length", geometry.line_summary("geom")["length"])


@query(
    "WITH v AS (SELECT l_orderkey AS n, sqrt(l_extendedprice) * 300 AS x, l_quantity * 1000 AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_quantity) AS k FROM lineitem), "
    "d AS (SELECT *, coalesce(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2), 0) AS side FROM v WINDOW w AS (PARTITION BY n ORDER BY k)), "
    "s AS (SELECT n, k, x, y, sum(side) OVER (PARTITION BY n ORDER BY k ROWS UNBOUNDED PRECEDING) AS m FROM d), "
    "g AS (SELECT n, max(m) AS total, count(*) AS corners, CAST(greatest(ceil(max(m) / 20000), 1) AS BIGINT) AS parts, arg_min(x, k) AS fx, arg_min(y, k) AS fy, arg_max(x, k) AS lx, arg_max(y, k) AS ly FROM s GROUP BY n), "
    "c AS (SELECT *, total * (part - 1) / parts AS a, CASE WHEN part = parts THEN total ELSE total * part / parts END AS b FROM (SELECT *, unnest(range(1, parts + 1)) AS part FROM g)), "
    "q AS (SELECT n, x, y, m, lead(x) OVER w AS x2, lead(y) OVER w AS y2, lead(m) OVER w AS m2 FROM s WINDOW w AS (PARTITION BY n ORDER BY k)), "
    "i AS (SELECT c.n, c.part, count(*) AS inner_points FROM c JOIN s ON s.n = c.n AND s.m > c.a AND s.m < c.b GROUP BY 1, 2) "
    "SELECT c.n, c.part, c.parts, CASE WHEN c.part = c.parts THEN CASE WHEN c.n > 1 THEN c.n // 2 END ELSE c.n END AS \"to\", round(c.b - c.a, 4) AS length, "
    "CASE WHEN c.parts = 1 THEN c.corners ELSE coalesce(i.inner_points, 0) + 2 END AS points, "
    "round(CASE WHEN c.part = 1 THEN c.fx ELSE p.x + (c.a - p.m) / (p.m2 - p.m) * (p.x2 - p.x) END, 4) AS x0, round(CASE WHEN c.part = 1 THEN c.fy ELSE p.y + (c.a - p.m) / (p.m2 - p.m) * (p.y2 - p.y) END, 4) AS y0, "
    "round(CASE WHEN c.part = c.parts THEN c.lx ELSE r.x + (c.b - r.m) / (r.m2 - r.m) * (r.x2 - r.x) END, 4) AS x1, round(CASE WHEN c.part = c.parts THEN c.ly ELSE r.y + (c.b - r.m) / (r.m2 - r.m) * (r.y2 - r.y) END, 4) AS y1 "
    "FROM c LEFT JOIN q p ON c.part > 1 AND p.n = c.n AND p.m <= c.a AND c.a < p.m2 LEFT JOIN q r ON c.part < c.parts AND r.n = c.n AND r.m <= c.b AND c.b < r.m2 LEFT JOIN i ON i.n = c.n AND i.part = c.part"
)
def split_line_geometry(spark, sf_dir):
    parts = network.split_long_lines(_bent_lines(spark, sf_dir), 20000.0).withColumn("s", geometry.line_summary("geom"))
    return parts.select("n", "part", "parts", "to", F.round("s.length", 4).alias("length"), "s.points", *[F.round(f"s.{c}", 4).alias(c) for c in ("x0", "y0", "x1", "y1")])


def _squares(spark, sf_dir):
    """A square for each part, 40 in a row."""
    key = F.col("p_partkey")
    x, y = (key % 40).cast("double"), F.floor(key / 40).cast("double")
    return table(spark, sf_dir, "part").select(key.alias("n"), geometry.rectangle(x, y, x + 1, y + 1).alias("geom"))


# a square's corners are its own and those one further; corners less sides plus squares is shapes less holes where units touch themselves in no corner alone
_SQUARES = (
    "e AS (SELECT unit, c, r, 0 AS d FROM u UNION SELECT unit, c, r + 1, 0 FROM u UNION SELECT unit, c, r, 1 FROM u UNION SELECT unit, c + 1, r, 1 FROM u), "
    "v AS (SELECT unit, c, r FROM u UNION SELECT unit, c + 1, r FROM u UNION SELECT unit, c, r + 1 FROM u UNION SELECT unit, c + 1, r + 1 FROM u), "
    "n AS (SELECT unit, count(*) AS squares, min(c) AS minx, max(r) + 1 AS maxy FROM u GROUP BY 1), es AS (SELECT unit, count(*) AS sides FROM e GROUP BY 1), vs AS (SELECT unit, count(*) AS corners FROM v GROUP BY 1)"
)


@query(
    "WITH u AS (SELECT CASE WHEN p_partkey % 40 % 3 = 1 AND p_partkey // 40 % 3 = 1 THEN -1 ELSE p_partkey % 40 // 3 + 100 * (p_partkey // 40 // 3) END AS unit, p_partkey % 40 AS c, p_partkey // 40 AS r FROM part), "
    + _SQUARES
    + " SELECT unit, CAST(squares AS DOUBLE) AS area, corners - sides + squares AS shapes_less_holes, 2 * sides - 4 * squares AS points, CAST(minx AS DOUBLE) AS minx, CAST(maxy AS DOUBLE) AS maxy FROM n JOIN es USING (unit) JOIN vs USING (unit)"
)
def dissolve_squares(spark, sf_dir):
    col, row = F.col("n") % 40, F.floor(F.col("n") / 40)
    unit = F.when((col % 3 == 1) & (row % 3 == 1), -1).otherwise(F.floor(col / 3) + 100 * F.floor(row / 3)).cast("bigint")
    merged = dissolve.dissolved(_squares(spark, sf_dir).select(unit.alias("unit"), "geom"))
    merged = merged.withColumns({"s": geometry.polygon_summary("geom"), "b": geometry.bounds("geom")})
    return merged.select("unit", "s.area", (F.col("s.outers") - F.col("s.holes")).alias("shapes_less_holes"), "s.points", "b.minx", "b.maxy")


@query(
    f"WITH RECURSIVE {_LINES}, d(n, z) AS (SELECT n, n FROM t UNION ALL SELECT d.n, t.o FROM d JOIN t ON t.n = d.z WHERE d.z % 11 <> 0 AND t.o IS NOT NULL), f AS (SELECT d.n, d.z FROM d JOIN t ON t.n = d.z WHERE d.z % 11 = 0 OR t.o IS NULL), "
    "u AS (SELECT z AS unit, n % 40 AS c, n // 40 AS r FROM f), " + _SQUARES + " SELECT unit, CAST(squares AS DOUBLE) AS area, 2 * sides - 4 * squares AS points, CAST(minx AS DOUBLE) AS minx, CAST(maxy AS DOUBLE) AS maxy FROM n JOIN es USING (unit)"
)
def merged_divides(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    merged = dissolve.merged_divides(_squares(spark, sf_dir), network.placed_at_outlets(lines, lines.where("n % 11 = 0").select("n")))
    merged = merged.withColumns({"s": geometry.polygon_summary("geom"), "b": geometry.bounds("geom")})
    return merged.select("unit", "s.area", "s.points", "b.minx", "b.maxy")


_BENT = (
    "g AS (SELECT p_partkey AS n, p_partkey % 40 AS c, p_partkey // 40 AS r FROM part), "
    "s AS (SELECT n, 0 AS k, 0 AS d, c, r FROM g UNION ALL SELECT n, 1, 1, c + 1, r FROM g UNION ALL SELECT n, 2, 0, c, r + 1 FROM g UNION ALL SELECT n, 3, 1, c, r FROM g), "
    "b AS (SELECT n, k, CASE WHEN count(*) OVER (PARTITION BY d, c, r) = 2 THEN (c * 7 + r * 13 + d) % 5 ELSE 0 END AS h FROM s)"
)


def _bent_squares(spark, sf_dir):
    """The squares with a vertex amid each side; sides of two squares are bent there, by up to 0.4."""
    key, c, r = F.col("p_partkey"), F.col("p_partkey") % 40, F.floor(F.col("p_partkey") / 40)
    sides = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(k % 2).alias("d"), (c + int(k == 1)).alias("c"), (r + int(k == 2)).alias("r")) for k in range(4)]))
    side = table(spark, sf_dir, "part").select(key.alias("n"), sides.alias("s")).select("n", "s.*")
    both = F.count(F.lit(1)).over(Window.partitionBy("d", "c", "r")) == 2
    side = side.withColumn("bend", F.when(both, (F.col("c") * 7 + F.col("r") * 13 + F.col("d")) % 5).otherwise(0) / 10)
    bend, across, low, high = F.col("bend"), F.col("d") == 0, F.col("c").cast("double"), F.col("r").cast("double")
    back = (F.col("k") > 1).cast("int")
    start = F.struct((F.col("k") * 2).alias("k"), F.when(across, low + back).otherwise(low).alias("x"), F.when(across, high).otherwise(high + back).alias("y"))
    middle = F.struct((F.col("k") * 2 + 1).alias("k"), F.when(across, low + 0.5).otherwise(low + bend).alias("x"), F.when(across, high + bend).otherwise(high + 0.5).alias("y"))
    ring = side.select("n", F.explode(F.array(start, middle)).alias("v")).groupBy("n").agg(F.sort_array(F.collect_list("v")).alias("v"))
    return ring.select("n", geometry.polygon("v.x", "v.y").alias("geom"))


@query(
    f"WITH {_BENT} SELECT n, round(CAST(1 + sum(CASE WHEN h < 3 THEN 0 WHEN k IN (1, 2) THEN h ELSE -h END) / 20 AS DOUBLE), 6) AS area, CAST(4 + count(*) FILTER (h >= 3) AS BIGINT) AS points FROM b GROUP BY n"
)
def simplified_squares(spark, sf_dir):
    simple = simplify.simplified(staged(_bent_squares(spark, sf_dir), "bent-squares"), 0.25).withColumn("s", geometry.polygon_summary("geom"))
    return simple.select("n", F.round("s.area", 6).alias("area"), "s.points")


@query(
    "WITH RECURSIVE v AS (SELECT l_orderkey AS n, sqrt(l_extendedprice) * 300 AS x, l_quantity * 1000 AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_quantity) AS k FROM lineitem), "
    "c AS (SELECT n, count(*) AS c FROM v GROUP BY 1), "
    "r(n, a, b) AS (SELECT n, CAST(1 AS BIGINT), c FROM c UNION ALL SELECT n, CASE WHEN half THEN k ELSE a END, CASE WHEN half THEN b ELSE k END FROM ("
    "SELECT *, row_number() OVER (PARTITION BY n, a, b ORDER BY away DESC, k) AS j FROM (SELECT n, a, b, k, sqrt((mx - t * ux) ** 2 + (my - t * uy) ** 2) AS away FROM ("
    "SELECT *, CASE WHEN ux * ux + uy * uy = 0 THEN 0 ELSE least(greatest((mx * ux + my * uy) / (ux * ux + uy * uy), 0), 1) END AS t FROM ("
    "SELECT r.n, r.a, r.b, m.k, q.x - p.x AS ux, q.y - p.y AS uy, m.x - p.x AS mx, m.y - p.y AS my FROM r JOIN v m ON m.n = r.n AND m.k > r.a AND m.k < r.b JOIN v p ON p.n = r.n AND p.k = r.a JOIN v q ON q.n = r.n AND q.k = r.b)))"
    ") CROSS JOIN (VALUES (false), (true)) h(half) WHERE j = 1 AND away > 8000) "
    "SELECT n, CAST(CASE WHEN any_value(c) = 1 THEN 1 ELSE 2 + (count(*) - 1) // 2 END AS BIGINT) AS points FROM r JOIN c USING (n) GROUP BY 1"
)
def simplified_lines(spark, sf_dir):
    return _bent_lines(spark, sf_dir).select("n", geometry.line_summary(geometry.simple_line(F.col("geom"), 8000.0))["points"].alias("points"))


# ---- flow directions

_FLOW = (
    "g AS (SELECT p_partkey % 50 AS c, p_partkey // 50 AS r, CASE WHEN p_partkey % 43 = 0 THEN 0 WHEN p_partkey % 37 = 0 THEN 16 WHEN p_size % 3 = 0 THEN 1 WHEN p_size % 3 = 1 THEN 4 ELSE 8 END AS d FROM part WHERE p_partkey % 97 <> 0), "
    "f AS (SELECT g.c, g.r, t.c AS tc, t.r AS tr FROM g LEFT JOIN g t ON g.d <> 0 AND t.c = g.c + CASE g.d WHEN 1 THEN 1 WHEN 4 THEN 0 ELSE -1 END AND t.r = g.r + CASE WHEN g.d IN (4, 8) THEN 1 ELSE 0 END), "
    "w(c, r, zc, zr) AS (SELECT c, r, c, r FROM g UNION SELECT w.c, w.r, f.tc, f.tr FROM w JOIN f ON f.c = w.zc AND f.r = w.zr WHERE f.tc IS NOT NULL), "
    "o AS (SELECT w.c, w.r, w.zc, w.zr FROM w JOIN f ON f.c = w.zc AND f.r = w.zr WHERE f.tc IS NULL), u AS (SELECT w.zc AS c, w.zr AS r, count(*) AS n FROM w GROUP BY 1, 2)"
)


@query(
    f"WITH RECURSIVE {_FLOW} SELECT u.c AS col, u.r AS row, o.zc AS outlet_col, o.zr AS outlet_row, CAST(CASE WHEN o.zc IS NOT NULL THEN u.n END AS BIGINT) AS upstream FROM u LEFT JOIN o ON o.c = u.c AND o.r = u.r"
)
def watersheds(spark, sf_dir):
    key, turn = F.col("p_partkey"), F.col("p_size") % 3
    code = F.when(key % 97 == 0, None).when(key % 43 == 0, 0).when(key % 37 == 0, 16).when(turn == 0, 1).when(turn == 1, 4).otherwise(8)
    return tiles.watersheds(table(spark, sf_dir, "part").select((key % 50).alias("col"), F.floor(key / 50).alias("row"), code.alias("dir")), tile=16)


# ---- main stems

_STEMS = (
    f"{_TOTAL}, m AS (SELECT n, o FROM (SELECT t.n, t.o, row_number() OVER (PARTITION BY t.o ORDER BY w.total DESC, t.n) AS k FROM t JOIN w ON w.n = t.n WHERE t.o IS NOT NULL) WHERE k = 1), "
    "p(n, z, place, reach) AS (SELECT n, n, 1, length FROM t UNION ALL SELECT p.n, m.o, p.place + 1, p.reach + t.length FROM p JOIN m ON m.n = p.z JOIN t ON t.n = m.o), "
    "s AS (SELECT n, z AS stem, place, reach FROM p WHERE z NOT IN (SELECT n FROM m))"
)


@query(f'WITH RECURSIVE {_STEMS} SELECT t.n, t.o AS "to", s.stem, CAST(s.place AS BIGINT) AS place, round(s.reach, 6) AS reach FROM t JOIN s ON s.n = t.n')
def main_stems(spark, sf_dir):
    return network.main_stems(_lines(spark, sf_dir)).select("n", "to", "stem", "place", F.round("reach", 6).alias("reach"))


@query(
    f"WITH RECURSIVE {_STEMS}, x AS (SELECT t.*, length < CASE WHEN n IN (SELECT n FROM m) THEN 2000 ELSE 1000 END AS short FROM t), "
    "d(n, z) AS (SELECT n, n FROM x UNION ALL SELECT d.n, x.o FROM d JOIN x ON x.n = d.z WHERE x.short AND x.o IS NOT NULL), f AS (SELECT d.n, d.z FROM d JOIN x ON x.n = d.z WHERE NOT x.short OR x.o IS NULL), "
    "q AS (SELECT f.z, sum(t.area) AS area, count(*) AS members FROM f JOIN t ON t.n = f.n GROUP BY 1) "
    'SELECT t.n, g.z AS "to", round(t.length, 6) AS length, CAST(q.area AS BIGINT) AS area, q.members FROM t JOIN q ON q.z = t.n LEFT JOIN f g ON g.n = t.o'
)
def collapse_along_main_stems(spark, sf_dir):
    return network.collapse_short_lines(_lines(spark, sf_dir), 1000.0, 2000.0).withColumn("length", F.round("length", 6))


@query(
    f"WITH RECURSIVE {_STEMS}, r(n, sl, sa) AS (SELECT n, length, CAST(area AS DOUBLE) FROM t WHERE n NOT IN (SELECT o FROM m) UNION ALL "
    "SELECT m.o, CASE WHEN sl >= 4000 AND sa >= 12 THEN 0 ELSE sl END + t.length, CASE WHEN sl >= 4000 AND sa >= 12 THEN 0 ELSE sa END + t.area FROM r JOIN m ON m.n = r.n JOIN t ON t.n = m.o), "
    "u AS (SELECT n FROM r WHERE sl >= 4000 AND (sa >= 12 OR (sa >= 6 AND n NOT IN (SELECT n FROM m)))), "
    "d(n, z) AS (SELECT n, n FROM t UNION ALL SELECT d.n, t.o FROM d JOIN t ON t.n = d.z WHERE t.o IS NOT NULL AND d.z NOT IN (SELECT n FROM u)), "
    "f AS (SELECT d.n, d.z FROM d JOIN t ON t.n = d.z WHERE t.o IS NULL OR d.z IN (SELECT n FROM u)) "
    "SELECT f.z AS unit, any_value(g.z) AS to_unit, CAST(sum(t.area) AS DOUBLE) AS area, sum(CASE WHEN a.stem = b.stem THEN t.length ELSE 0 END) AS length, count(*) AS members "
    "FROM f JOIN t ON t.n = f.n JOIN s a ON a.n = f.n JOIN s b ON b.n = f.z JOIN t k ON k.n = f.z LEFT JOIN f g ON g.n = k.o GROUP BY 1"
)
def aggregate_along_stems(spark, sf_dir):
    return stems.aggregate_along_stems(_lines(spark, sf_dir), 12.0, 6.0, 4000.0)


# ---- subsets without a search

_TREE = "e AS (SELECT p_partkey AS n, CASE WHEN p_partkey >= 1 THEN p_partkey // 2 END AS o FROM part UNION SELECT 0, NULL)"


@query(
    f"WITH RECURSIVE {_TREE}, a(n, up) AS (SELECT n, n FROM e UNION ALL SELECT e.o, a.up FROM a JOIN e ON e.n = a.n WHERE e.o IS NOT NULL), z AS (SELECT n, count(*) AS size FROM a GROUP BY 1), "
    "b AS (SELECT e.n, e.o, z.size, 1 + coalesce(sum(z.size) OVER (PARTITION BY e.o ORDER BY e.n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS behind FROM e JOIN z ON z.n = e.n), "
    "p(n, first) AS (SELECT n, behind FROM b WHERE o IS NULL UNION ALL SELECT b.n, p.first + b.behind FROM p JOIN b ON b.o = p.n) "
    'SELECT b.n AS node, b.o AS "to", CAST(p.first AS BIGINT) AS first, CAST(p.first + b.size - 1 AS BIGINT) AS last FROM b JOIN p ON p.n = b.n'
)
def interval_index(spark, sf_dir):
    return intervals.interval_index(_edges(spark, sf_dir))


def _index(spark, sf_dir):
    path = fresh_path(spark, "intervals")
    intervals.write_index(_edges(spark, sf_dir), path)
    return intervals.read_index(spark, path)


@query(
    "WITH RECURSIVE e AS (SELECT p_partkey AS fn, p_partkey // 2 AS tn FROM part WHERE p_partkey >= 1), u(n) AS (SELECT * FROM (VALUES (CAST(5 AS BIGINT)), (21), (33), (-8)) UNION SELECT e.fn FROM e JOIN u ON e.tn = u.n) SELECT n AS node FROM u"
)
def upstream_by_intervals(spark, sf_dir):
    outlets = spark.createDataFrame([(5,), (21,), (33,), (-8,)], "node bigint")
    return intervals.upstream(_index(spark, sf_dir), outlets)


@query(SQL["upstream_with_sibling"])
def upstream_with_sibling_by_intervals(spark, sf_dir):
    return intervals.upstream(_index(spark, sf_dir), _outlet(spark), with_sibling=True)
