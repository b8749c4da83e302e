import json
import math

import pytest
from pyspark.sql import functions as F

from tarnworks.functions import display
from tarnworks.functions.ids import number_of, typed, whole, with_prefix
from tarnworks.functions.text import compact_time, fixed, grouped, low_bytes
from tarnworks.operators import aggregates, attributes, features, graph, network, pointers, raster, relational
from tarnworks.operators.subset import subset


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def edges(spark):
    chain = [(0, 3, 1, 2), (2, 2, 3, 1), (0, 4, 1, 2), (0, 9, 1, 1), (0, 8, 4, 9), (0, 4, 1, 2), (0, 20, 1, 21), (0, 21, 1, 20), (1, 50, 1, 2), (0, 51, 0, 2), (0, 3, 1, 7)]
    return spark.createDataFrame([(*e, k) for k, e in enumerate(chain)], "ft int, fn bigint, tt int, tn bigint, pos bigint")


def _nodes(spark, *n):
    return spark.createDataFrame([(k,) for k in n], "node bigint")


def test_graph(spark, edges):
    kept = graph.typed_edges(edges)
    assert kept.count() == 9
    assert dict(rows(graph.downstream_first(kept)))[3] == 2
    assert dict((r.tn, r.parents) for r in graph.adjacency(kept).collect())[2] == [3, 4]
    up = lambda *n, **k: {r[0] for r in graph.upstream(kept, _nodes(spark, *n), **k).collect()}
    assert up(2) == {2, 3, 4}
    assert up(2, with_sibling=True) == {2, 3, 4, 8, 9}
    assert up(20) == {20, 21} and up(777) == {777} and up(777, with_sibling=True) == {777}
    chosen = graph.upstream(kept, _nodes(spark, 2))
    assert {r.id for r in graph.nexus_ids(kept, chosen, _nodes(spark, 2)).collect()} == {"nex-2", "nex-1"}
    tree = spark.createDataFrame([(k, k // 2) for k in range(1, 200)], "fn bigint, tn bigint")
    want = rows(graph.upstream(tree, _nodes(spark, 5)))
    assert rows(graph.upstream_of_tree(tree, 5)) == want
    line = spark.createDataFrame([(k, k - 1) for k in range(1, 300)], "fn bigint, tn bigint")
    assert graph.upstream_of_tree(line, 100).count() == 200


def test_subset(spark, edges):
    pois = spark.createDataFrame([("wb-3", 7), ("wb-4", None), ("wb-8", 9)], "id string, poi_id int")
    tables = {
        "divides": spark.createDataFrame([(f"cat-{k}",) for k in range(10)], "divide_id string"), "network": spark.createDataFrame([("wb-2",), ("nex-2",), ("nex-1",), ("nex-5",)], "id string"),
        "nexus": spark.createDataFrame([("nex-2",), ("nex-9",)], "id string"), "pois": pois, "lakes": spark.createDataFrame([(7, 1.0), (9, 2.0), (None, 3.0)], "poi_id int, area double"),
        "flowpaths": spark.createDataFrame([], "id string, x int"),
    }
    got = subset(tables, edges.where("fn NOT IN (8, 9)"), _nodes(spark, 2))
    assert rows(got["divides"]) == [("cat-2",), ("cat-3",), ("cat-4",)]
    assert rows(got["network"]) == [("nex-1",), ("nex-2",), ("wb-2",)] and rows(got["nexus"]) == [("nex-2",)]
    assert rows(got["lakes"]) == [(7, 1.0)] and got["flowpaths"].columns == ["id", "x"]
    with pytest.raises(ValueError):
        subset({"lakes": tables["lakes"]}, edges, _nodes(spark, 2))


def test_corrections(spark):
    table = spark.createDataFrame([(1, 5.0, 2), (1, 6.0, 3), (2, 7.0, None), (None, 8.0, 1)], "flowpath_id int, lengthkm double, streamorder int")
    patches = spark.createDataFrame([(1, 9.0, None, "x", 0), (1, None, None, "x", 1), (2, None, 4, "x", 2), (3, 1.0, 1, "x", 3), (1, 10.0, None, "x", 4)], "id int, lengthkm double, streamorder int, unknown string, ord bigint")
    assert rows(relational.corrected(table, patches, "flowpath_id", "ord")) == [(1, 10.0, 2), (1, 10.0, 3), (2, 7.0, 4), (None, 8.0, 1)]


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "j int, v string")
    joined = relational.left_join(left, right, {"k": "j"})
    assert joined.columns == ["k", "v", "v_right"]
    assert rows(joined) == [(1, "a", "x"), (1, "a", "y"), (3, "c", None), (None, "b", "z")]
    parts = [spark.createDataFrame(p, f"divide_id int, {c} int") for p, c in (([(1, 1), (2, 1)], "a"), ([(2, 2), (3, 2)], "b"), ([(3, 3), (None, 3)], "c"))]
    assert rows(relational.full_join_all(parts, "divide_id")) == [(1, 1, None, None), (2, 1, 2, None), (3, None, 2, 3), (None, None, None, 3)]


def test_aggregates(spark):
    data = [("a", 1.0, 2.0), ("a", None, 9.0), ("a", 3.0, 6.0), ("b", 1.0, None), ("b", 2.0, 1.0), ("c", 1.0, 0.0), ("d", None, 1.0)]
    table = spark.createDataFrame(data, "k string, x double, w double")
    assert rows(table.groupBy("k").agg(aggregates.weighted_mean(F.col("x"), F.col("w")).alias("m"))) == [("a", 2.5), ("b", None), ("c", None), ("d", None)]
    cells = spark.createDataFrame([("z", 1.0, 2.0), ("z", 2.0, 2.0), ("z", None, 50.0), ("z", 4.0, 1.0)], "divide_id string, value double, coverage double")
    at = lambda f: raster.zonal(cells, f, ["divide_id"], "v").first().v
    assert at("mode") == 2.0 and at("mean") == pytest.approx(2.0)
    assert at("geometric_mean") == pytest.approx(math.exp((2 * math.log(2) + math.log(4)) / 5))
    angles = spark.createDataFrame([("z", 350.0, 1.0), ("z", 10.0, 1.0)], "divide_id string, value double, coverage double")
    mean = raster.zonal(angles, "circular_mean", ["divide_id"], "v").first().v
    assert min(mean, 360 - mean) == pytest.approx(0, abs=1e-9)
    modes = spark.createDataFrame([(1,), (2,), (2,), (1,), (None,), (None,), (None,)], "x int")
    assert modes.agg(aggregates.mode_of("x")).first()[0] == 2


def test_attributes(spark):
    walk = spark.createDataFrame([("1", "d"), ("1", "d"), ("2.9", "d"), ("x", "e"), (None, "e")], "reference_id string, divide_id string")
    basins = spark.createDataFrame([(1.0, 2.0, 1.0, 4.0, 1.9), (2.0, 5.0, 2.0, 1.0, 3.2)], "ComID double, Coeff double, Area_sqkm double, Zmax double, Expon double")
    assert rows(attributes.groundwater(walk, basins)) == [("d", 3.5, 2.5, 1)]
    soil = spark.createDataFrame([("d", n, k, 2.0, 1.0) for n in ("bexp", "dksat", "smcmax") for k in (1, 2)], "divide_id string, name string, layer int, value double, coverage double")
    wide = attributes.soils(soil, {"bexp": "mode", "dksat": "geometric_mean", "smcmax": "mean"})
    assert {"mode.bexp_1", "geom_mean.dksat_2", "mean.smcmax_4"} <= set(wide.columns)
    assert wide.first()["geom_mean.dksat_2"] == pytest.approx(2.0) and wide.first()["mean.smcmax_4"] is None


def test_grids(spark):
    plane = spark.createDataFrame([(c, r, 2.0 * c) for c in range(5) for r in range(4)], "col int, row int, value double")
    got = raster.terrain(plane).collect()
    assert len(got) == 6 and all(r.slope == pytest.approx(math.degrees(math.atan(2))) and r.aspect == pytest.approx(270) for r in got)
    tiles = spark.createDataFrame([(0, 0, 1.0, 1), (0, 0, 2.0, 2), (0, 0, None, 3), (1, 0, None, 1)], "col int, row int, value double, tile int")
    assert rows(raster.mosaic(tiles)) == [(0, 0, 2.0), (1, 0, None)]
    assert raster.grid_names(spark, ["a", "b"], [1, 2]).count() == 4


def test_overlay(spark):
    from tarnworks.functions.geometry import write_polygon

    ring = [(0.5, 0.5), (3.5, 0.5), (3.5, 2.5), (0.5, 2.5), (0.5, 0.5)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    triangle = [(-2.0, -2.0), (-1.0, -2.0), (-2.0, -1.0), (-2.0, -2.0)]
    zones = spark.createDataFrame([("z", write_polygon([ring, hole])), ("t", write_polygon([triangle])), ("n", None)], "zone string, geom binary")
    cells = spark.createDataFrame([(c, r) for c in range(-3, 6) for r in range(-3, 6)], "col int, row int")
    for tile in (2, 64):
        got = {(r.zone, r.col, r.row): r.coverage for r in raster.overlay(zones, cells, tile=tile).collect()}
        assert got[("z", 0, 0)] == pytest.approx(0.25) and ("z", 1, 1) not in got and got[("z", 2, 1)] == pytest.approx(1)
        assert sum(v for k, v in got.items() if k[0] == "z") == pytest.approx(5.0)
        assert got[("t", -2, -2)] == pytest.approx(0.5)


def test_network_steps(spark):
    lines = spark.createDataFrame([(1, None, 500.0, 4), (2, 1, 100.0, 3), (3, 2, 2600.0, 2), (4, 2, 50.0, 1), (5, 4, 10.0, 1)], "n bigint, to bigint, length double, area bigint")
    parts = network.split_long_lines(lines, 1000.0)
    assert rows(parts.where("n = 3").select("part", F.round("length", 3), "to", "to_part")) == [(1, 866.667, 3, 2), (2, 866.667, 3, 3), (3, 866.667, 2, 1)]
    assert rows(network.collapse_short_lines(lines, 200.0).select("n", "to", "area", "members")) == [(1, None, 9, 4), (3, 1, 2, 1)]
    assert dict((r.n, r.total) for r in network.total_drainage(lines).collect()) == {1: 11, 2: 7, 3: 2, 4: 2, 5: 1}
    units = network.aggregate_to_size(lines, 5, 2)
    assert units.agg(F.sum("area"), F.sum("members")).first()[:] == (11, 5)
    outlets = network.aggregate_to_outlets(lines, spark.createDataFrame([(2,)], "n bigint"))
    assert rows(outlets) == [(1, None, 4, 1), (2, 1, 7, 4)]
    assert network.total_drainage(lines.limit(0)).count() == 0 and network.aggregate_to_size(lines.limit(0), 5, 2).count() == 0


def test_network_steps_on_cycles_and_open_ends(spark):
    # 1 -> 2 -> 3 -> 1 with 4 flowing in, and 5 -> 6 -> out of the table
    lines = spark.createDataFrame([(1, 2, 9.0, 1), (2, 3, 9.0, 2), (3, 1, 9.0, 4), (4, 2, 900.0, 8), (5, 6, 9.0, 16), (6, 99, 9.0, 32)], "n bigint, to bigint, length double, area bigint")
    assert rows(network.collapse_short_lines(lines, 100.0).select("n", "to", "area", "members")) == [(1, None, 7, 3), (4, 1, 8, 1), (6, None, 48, 2)]
    assert dict((r.n, r.total) for r in network.total_drainage(lines).collect()) == {1: 15, 2: 10, 3: 14, 4: 8, 5: 16, 6: 48}
    for units in (network.aggregate_to_size(lines, 5, 2), network.aggregate_to_outlets(lines, spark.createDataFrame([(4,), (99,)], "n bigint"))):
        assert units.agg(F.sum("area"), F.sum("members")).first()[:] == (63, 6)
        assert units.where("unit = to_unit").count() == 0
    two = spark.createDataFrame([(7, 8, 1.0, 1), (8, 7, 1.0, 1)], "n bigint, to bigint, length double, area bigint")
    assert rows(network.collapse_short_lines(two, 5.0)) == [(7, None, 1.0, 2, 2)]


def test_reconcile(spark):
    flowpaths = spark.createDataFrame([("fp-1", "nex-2", "f", "m"), ("fp-1", "nex-3", "f", "m")], "flowpath_id string, flowpath_toid string, flowline_id string, member_comid string")
    divides = spark.createDataFrame([("cat-1", "fp-1"), ("cat-9", "fp-9"), ("cat-0", None)], "divide_id string, flowpath_id string")
    assert rows(network.reconciled_divides(divides, flowpaths, "16")) == [("cat-0", None, None, "16"), ("cat-1", "nex-2", "wb-1", "16"), ("cat-1", "nex-3", "wb-1", "16"), ("cat-9", None, "wb-9", "16")]
    assert network.reconciled_flowpaths(flowpaths, "16").columns == ["id", "toid", "vpuid"]
    nexus = spark.createDataFrame([("nex-1", "fp-4"), ("nex-2", None)], "nexus_id string, nexus_toid string")
    walk = spark.createDataFrame([("fp-1", 3), ("fp-1", 4), ("fp-1", 4), ("fp-2", None)], "flowpath_id string, poi_id int")
    assert rows(network.reconciled_nexus(nexus, walk, "16")) == [("nex-1", "wb-4", 3, "nexus", "16"), ("nex-1", "wb-4", 4, "nexus", "16"), ("nex-2", None, None, "nexus", "16")]


def test_ids_and_display(spark):
    table = spark.createDataFrame([("fp-12", "12.9", 5.0), ("xfp-1", "x", 25.0), (None, None, None)], "id string, t string, z double")
    got = table.select(number_of(F.col("id")), with_prefix(F.col("id"), "fp", "wb"), whole(F.col("t")), typed("cat", F.col("z").cast("int"))).collect()
    assert [tuple(r) for r in got] == [(12, "wb-12", 12, "cat-5"), (1, "xfp-1", None, "cat-25"), (None, None, None, None)]
    z = table.select(display.interpolate(F.col("z"), [(10, 0), (30, 4)]).alias("a"), display.match(F.col("id"), {("fp-12", "y"): 1}, 0).alias("b")).collect()
    assert [r.a for r in z][:2] == [0.0, 3.0] and [r.b for r in z] == [1, 0, 0]
    keep = lambda rule: table.where(display.feature_filter(rule)).count()
    assert keep(["!", ["has", "z"]]) == 1 and keep(["!=", "z", 5]) == 2 and keep(["any", ["<", "z", 6], ["!in", "id", "fp-12"]]) == 3 and keep(["all"]) == 3


def test_pointers(spark):
    text = "deps:\n  md5: keep\n  size: 1\nfrozen: true\nouts:\n- md5: no\n  md5: gone\n  size: 2\n  frozen: true\nouts:\n  path: p"
    files = spark.createDataFrame([("a/b/x.dvc", text), ("a/b/y.dvc", "deps:"), ("a/z", None)], "path string, text string")
    got = files.select(pointers.cleaned(F.col("text"))).collect()
    assert got[0][0] == "deps:\n  md5: keep\n  size: 1\nouts:\n- md5: no\nouts:\n  path: p" and got[1][0] == "deps:" and got[2][0] is None
    assert rows(pointers.tallies(files)) == [("a", 0, 0), ("a/b", 1, 1)]
    assert rows(pointers.tracked(files.limit(1))) == [("p", "keep", 1)]
    assert [r[0] for r in files.select(pointers.removed(F.col("text"))).collect()] == [["frozen: true", "  md5: gone", "  size: 2", "  frozen: true"], [], None]
    assert [r.path for r in pointers.rewritten(files).collect()] == ["a/b/x.dvc"]
    listing = spark.createDataFrame([("p", 1), ("p", 5)], "path string, size bigint")
    named = spark.createDataFrame([("outs:\n- path: p\n  size: 1",), ("outs:\n- path: p\n  size: 2",), ("outs:\n- path: p",), ("outs:\n- path: q",), (None,)], "text string")
    assert [r.there for r in pointers.present(named, listing).orderBy(F.desc("there"), "path").collect()] == [True, True, False, False, False]


def test_display_expressions(spark):
    table = spark.createDataFrame([("a", 5, "LineString"), ("b", None, "Polygon"), (None, 9, "Polygon")], "kind string, `name:en` int, shape string")
    found = lambda rule, **k: [r[0] for r in table.select(display.expression(rule, **k)).collect()]
    assert found(["coalesce", ["get", "name:en"], -1]) == [5, -1, 9]
    assert found(["==", ["get", "kind"], "a"]) == [True, False, False] and found(["!=", ["get", "kind"], "a"]) == [False, True, True]
    assert found(["format", ["get", "kind"], {"size": 1}, "-", {}, ["get", "name:en"]]) == ["a-5", "b-", "-9"]
    assert found(["match", ["get", "kind"], ["a", "c"], "x", "b", "y", "z"]) == ["x", "y", "z"]
    assert found([">=", ["zoom"], ["+", ["get", "name:en"], 2]], zoom=8) == [True, False, False]
    assert found(["in", ["get", "kind"], ["literal", ["b"]]]) == [False, True, False] and found(["any"]) == [False] * 3
    assert found(["interpolate", ["linear"], ["get", "name:en"], 4, 0.0, 8, 8.0]) == [2.0, 0.0, 8.0]
    for rule in (["zoom"], ["geometry-type"], ["blur", 1]):
        with pytest.raises(ValueError):
            display.expression(rule)
    kept = lambda rule, **k: table.where(display.feature_filter(rule, **k)).count()
    assert kept(["==", ["geometry-type"], "Polygon"], geometry_type=F.col("shape")) == 2
    assert kept(["all", ["!", ["has", "kind"]], [">", ["get", "name:en"], 6], ["in", "shape", "Polygon"]]) == 1
    drawn = table.select(display.visible(6, F.col("`name:en`"), F.lit(7)).alias("d"), display.visible(7, F.lit(1), F.lit(7)).alias("e")).collect()
    assert [r.d for r in drawn] == [True, True, False] and not any(r.e for r in drawn)


def test_display_colours_and_stops(spark):
    table = spark.createDataFrame([("a", 5, "#0f0"), ("b", None, "x"), (None, 9, "rgb(1, 2,3)")], "kind string, n int, c string")
    found = lambda rule, **k: [r[0] for r in table.select(display.expression(rule, **k)).collect()]
    parts = lambda rule, **k: [tuple(v) if v else None for v in found(rule, **k)]
    assert parts(["rgba", 1, 2, 3, 0.5]) == [(1, 2, 3, 0.5)] * 3 and parts(["rgb", ["+", ["get", "n"], 1], 0, 0])[0] == (6, 0, 0, 1)
    assert parts(["to-color", ["get", "c"]]) == [(0, 255, 0, 1), None, (1, 2, 3, 1)]
    # opaque red to a transparent black: the red stays red and only fades
    assert parts(["interpolate", ["linear"], ["zoom"], 4, "#ff0000", 8, ["rgba", 0, 0, 0, 0]], zoom=6)[0] == (255, 0, 0, 0.5)
    assert parts(["interpolate", ["linear"], ["get", "n"], 4, "#000", 6, "#fff"])[0] == (127.5, 127.5, 127.5, 1)
    assert parts(["case", ["has", "kind"], ["coalesce", ["get", "c"], "#111"], ["rgba", 0, 0, 0, 1]]) == [(0, 255, 0, 1), (17, 17, 17, 1), (0, 0, 0, 1)]
    assert found({"stops": [[7, 0], [11, 1]]}, zoom=8) == [0.25] * 3 and found({"stops": [[7, 0], [11, 1]]}, zoom=20) == [1.0] * 3
    assert found({"stops": [[4, "p"], [6, "q"]], "property": "n"}) == ["p", "p", "q"]
    assert parts({"stops": [[4, "#000"], [6, "#fff"]], "property": "n"})[2] == (255, 255, 255, 1)
    assert found(["step", ["get", "n"], ["get", "kind"], 6, ["case", ["has", "kind"], "k", "none"]]) == ["a", "b", "none"]
    assert found(["interpolate", ["linear"], ["zoom"], 2, ["step", ["get", "n"], 0, 6, 8], 4, 10], zoom=3) == [5.0, 5.0, 9.0]
    assert found(["Some Sans Regular"])[0] == ["Some Sans Regular"] and found([1.1, 0.0])[0] == [1.1, 0.0]
    texts = spark.createDataFrame([("plain",), ("\u0627",), ("x\u0e01",), ("\u0915",), (None,), ("",)], "t string")
    assert [r[0] for r in texts.select(display.expression(["is-supported-script", ["get", "t"]])).collect()] == [True, False, True, False, False, True]
    assert table.select(display.colour_text(display.colour_of(F.col("c")))).collect()[0][0] == "rgba(0,255,0,1.000)"
    for rule in ({"stops": [[7, 0], [11, 1]]}, {"base": 2}):
        with pytest.raises(ValueError):
            display.expression(rule)


def test_features(spark):
    from tarnworks.functions.geometry import write_polygon

    square = write_polygon([[(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 0.0)]])
    table = spark.createDataFrame([(1, "x", b"1", square), (2, None, None, square), (3, "z", None, b"?"), (4, "z", None, None)], "n int, `a.b` string, raw binary, geom binary")
    made = features.features(table, keep=["n"], project=False)
    got = {r.n: r for r in made.collect()}
    assert set(got) == {1, 2} and json.loads(got[1].feature)["properties"] == {"n": 1, "a.b": "x", "raw": None} and json.loads(got[2].feature)["properties"]["a.b"] is None
    assert tuple(got[1].box) == (0.0, 0.0, 2.0, 1.0)
    one = features.collections(made.withColumn("g", F.lit("g")), "g", "n").collect()[0]
    assert len(json.loads(one["collection"])["features"]) == 2 and one.maxx == 2.0
    assert json.loads(features.features(table.select("geom"), project=False).first().feature)["properties"] == {}
    assert features.features(table.limit(0)).count() == 0


def test_feature_lines(spark, tmp_path):
    from tarnworks.functions.geometry import point

    rows = spark.range(5).select("id", point(F.col("id").cast("double"), F.lit(1.0)).alias("geom"))
    features.write_features(features.features(rows, project=False), str(tmp_path / "f"))
    assert sorted(json.loads(r.value)["properties"]["id"] for r in spark.read.text(str(tmp_path / "f")).collect()) == list(range(5))


def test_texts(spark):
    table = spark.createDataFrame([("é€\U0001f600", 1234567.5), (None, None)], "t string, n double")
    got = table.select(low_bytes(F.col("t")), grouped(F.col("n"), 1), fixed(F.col("n"), 0)).collect()
    assert tuple(got[0]) == (bytearray([0xE9, 0xAC, 0x3D, 0x00]), "1,234,567.5", "1234568") and got[1][0] is None and got[1][1] is None
    assert spark.sql("SELECT timestamp_seconds(1700000000) AS t").select(compact_time(F.col("t"))).first()[0] == "20231114T221320Z"


def test_region(spark):
    table = spark.createDataFrame([(2, 0, 0, 0, 0, "b"), (1, 0, 0, 0, 0, None), (3, 0, 0, 0, 0, "a")], "n int, a int, b int, c int, d int, e string")
    assert relational.region_of(table, "n").first()[0] is None and relational.region_of(table.where("n > 1"), "n").first()[0] == "b"
    assert relational.region_of(table.withColumn("vpuid", F.col("n") + 10), "n").first()[0] == "11" and relational.region_of(table.select("n"), "n").first()[0] is None


def test_covered_cells_of_a_tile():
    from tarnworks.functions.geometry import write_polygon

    ring = [(0.13, -0.31), (1.97, 0.42), (1.1, 1.63), (0.13, -0.31)]
    whole = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))) / 2
    for size, tile in ((0.1, 7), (0.3, 2), (5.0, 3)):
        side = [k for k in range(-math.ceil(1 / (size * tile)) - 1, math.ceil(2 / (size * tile)) + 1)]
        found = [c for x in side for y in side for c in raster.covered_cells(write_polygon([ring]), x, y, tile, size)]
        assert len({c[:2] for c in found}) == len(found) and sum(c[2] for c in found) * size * size == pytest.approx(whole)
        assert all(0 < c[2] <= 1 + 1e-9 for c in found)
    assert raster.covered_cells(None, 0, 0, 4, 1.0) == []
