"""Line cutting, merged polygons, main stems, units along them and the interval index against plain loops."""

import math
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnworks.functions import geometry
from tarnworks.operators import dissolve, graph, intervals, network, stems
from tarnworks.plans import preparation as plan


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def line(points):
    return geometry.write_line(np.array(points, float))


def length_of(points):
    return sum(math.dist(a, b) for a, b in zip(points, points[1:]))


# ---- cutting lines


@pytest.mark.parametrize("seed", range(5))
def test_cut_parts_follow_one_another(seed):
    rng = random.Random(seed)
    points = [(rng.uniform(0, 1e5), rng.uniform(0, 1e5)) for _ in range(rng.randrange(2, 60))]
    points = [p for p in points for _ in range(1 + (rng.random() < 0.2))]  # repeated vertices
    for parts in (1, 2, 7, 100):
        cut = [geometry.parse(g)[1] for g in geometry.cut_line_of(line(points), parts)]
        assert len(cut) == parts and cut[0][0] == points[0] and cut[-1][-1] == points[-1]
        assert all(a[-1] == b[0] for a, b in zip(cut, cut[1:]))
        total = length_of(points)
        assert all(length_of(c) == pytest.approx(total / parts, abs=1e-6) for c in cut)
        inner = [p for c in cut for p in c[1:-1]]
        assert parts == 1 or [p for p in dict.fromkeys(points[1:-1]) if p not in (points[0], points[-1])] == list(dict.fromkeys(inner))


def test_cut_odd_lines():
    two = struct.pack("<BII", 1, geometry.MULTILINE, 2) + line([(0, 0), (4, 0)]) + line([(10, 0), (10, 4)])
    first, second, third = (geometry.parse(g) for g in geometry.cut_line_of(two, 3))
    assert first == (geometry.LINE, [(0.0, 0.0), (8 / 3, 0.0)]) and third[0] == geometry.LINE
    assert second[0] == geometry.MULTILINE and [p[1][0] for p in second[1]] == [(8 / 3, 0.0), (10.0, 0.0)]
    halves = [geometry.parse(g) for g in geometry.cut_line_of(two, 2)]
    assert halves == [(geometry.LINE, [(0.0, 0.0), (4.0, 0.0)]), (geometry.LINE, [(10.0, 0.0), (10.0, 4.0)])]
    assert [geometry.parse(g)[1] for g in geometry.cut_line_of(line([(0, 0), (1, 0), (2, 0)]), 2)] == [[(0.0, 0.0), (1.0, 0.0)], [(1.0, 0.0), (2.0, 0.0)]]
    still = line([(3, 3), (3, 3)])
    assert geometry.cut_line_of(still, 3) == [still, None, None]
    for bad in (None, b"", b"\x01\x02", struct.pack("<BIdd", 1, 1, 0, 0), line([(0, 0), (float("nan"), 1)]), line([(0, 0), (1, 1)])[:-3]):
        assert geometry.cut_line_of(bad, 2) == [None, None]


def test_lines_of_a_batch_are_made_measured_and_thinned_as_each_alone(spark):
    rng = random.Random(4)
    found = [[(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(rng.choice([1, 2, 3, 5, 20, 70]))] for _ in range(300)]
    found[7] = [(1.0, 2.0), (None, 3.0), (4.0, 5.0)]
    table = spark.createDataFrame([(k, [x for x, _ in v], [y for _, y in v]) for k, v in enumerate(found)] + [(300, None, None), (301, [], [])], "n int, x array<double>, y array<double>")
    made = table.repartition(3).select("n", geometry.line("x", "y").alias("geom"))
    simple = geometry.simple_line(F.col("geom"), 2.0)
    got = made.select("n", "geom", simple.alias("simple"), geometry.line_summary("geom").alias("s"), geometry.line_summary(simple)["points"].alias("points")).orderBy("n").collect()
    for k, v in enumerate(found):
        if k != 7:
            whole, thin = line(v), geometry.simple_line_of(line(v), 2.0)
            assert (bytes(got[k].geom), bytes(got[k].simple), got[k].points) == (whole, thin, len(geometry.parse(thin)[1]))
            assert tuple(got[k].s) == (*v[0], *v[-1], pytest.approx(length_of(v)), len(v))
    assert [bytes(got[k].geom) if got[k].geom is not None else None for k in (300, 301)] == [None, geometry.write_line(np.empty((0, 2)))]
    for k in (7, 300, 301):
        assert got[k].simple is None and got[k].points is None and tuple(got[k].s or (None,) * 6) == (None,) * 6


def test_lines_of_a_batch_take_no_python_value_each(monkeypatch):
    # by batch: 2,000 lines of five sizes are neither read nor written one by one
    counts = np.array([1, 2, 3, 5, 8] * 400)
    points = np.random.default_rng(2).uniform(0, 9, (counts.sum(), 2))
    starts = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    xs, ys = (pa.ListArray.from_arrays(starts, pa.array(points[:, k])) for k in (0, 1))
    simple = []
    monkeypatch.setattr(geometry.F, "arrow_udf", lambda kind: lambda f: lambda geom: simple.append(f) or geom)
    geometry.simple_line(None, 2.0)
    for name in ("_pieces", "simple_line_of", "_measured", "parse"):
        monkeypatch.setattr(geometry, name, None)
    made = geometry.line.func(xs, ys)
    thin = simple[0](made)
    summary = geometry.line_summary.func(thin)
    assert made.to_pylist() == [geometry.write_line(p) for p in np.split(points, np.cumsum(counts)[:-1])]
    assert summary.field("points").to_pylist() == [int(geometry.kept_vertices(p, 2.0).sum()) for p in np.split(points, np.cumsum(counts)[:-1])]
    assert geometry.line_summary.func(made.slice(3, 9)).equals(geometry.line_summary.func(made).slice(3, 9))


def test_alike_lines_are_found_among_odd_ones():
    head, good = geometry._LINE_HEAD, [line([(k, j) for j in range(n)]) for k, n in enumerate((1, 2, 2, 3, 40))]
    many = struct.pack("<BII", 1, geometry.MULTILINE, 1) + good[1]
    odd = [None, b"", good[1][:-3], good[1] + b"\0", head, head + b"\0\0\0\0", many, line([(0, 0), (float("inf"), 1)]), b"\0" + good[1][1:], good[3][:5] + b"\2\0\0\0" + good[3][9:]]
    geoms = [g for pair in zip(odd, good * 2) for g in pair]
    alike, rest = geometry._alike(geoms, head, 1)
    assert sorted(rest) == list(range(0, 20, 2))
    assert {k: xy.tolist() for places, found in alike for k, xy in zip(places.tolist(), found)} == {k: [list(v) for v in geometry.parse(geoms[k])[1]] for k in range(1, 20, 2)}
    assert geometry._alike([], head, 1) == ([], [])


def test_split_lines_with_geometry(spark):
    table = spark.createDataFrame([(1, 2, 10.0, line([(0, 0), (3, 0), (3, 7)])), (2, None, 2.0, line([(3, 7), (5, 7)])), (3, 2, 9.0, None)], "n bigint, to bigint, length double, geom binary")
    got = network.split_long_lines(table, 4.0)
    assert [r[:6] for r in rows(got.drop("geom"))] == [r[:6] for r in rows(network.split_long_lines(table.drop("geom"), 4.0))]
    ends = {(r.n, r.part): (r.s["x0"], r.s["y0"], r.s["x1"], r.s["y1"]) for r in got.withColumn("s", geometry.line_summary("geom")).collect() if r.s and r.s["x0"] is not None}
    assert set(ends) == {(1, 1), (1, 2), (1, 3), (2, 1)}
    assert ends[1, 1] == pytest.approx((0, 0, 3, 1 / 3)) and ends[1, 3] == pytest.approx((3, 11 / 3, 3, 7))


# ---- merging polygons


def polygon(*rings):
    return geometry.write_polygon([[*r, r[0]] for r in rings])


def covers(shape, x, y):
    return sum(dissolve._inside(x, y, r) for p in geometry.rings_of(shape) for r in p) % 2 == 1


@pytest.mark.parametrize("seed", range(2))
def test_merged_cells_cover_what_they_covered(spark, seed):
    rng, size = random.Random(seed), 9
    at = {(c, r): (c + rng.uniform(-0.2, 0.2), r + rng.uniform(-0.2, 0.2)) for c in range(size + 1) for r in range(size + 1)}
    unit = {(c, r): rng.choice([1, 1, 1, 2, 3]) for c in range(size) for r in range(size)}
    cells = {(c, r): [at[c, r], at[c + 1, r], at[c + 1, r + 1], at[c, r + 1]] for c, r in unit}
    table = [(unit[k], polygon(p if rng.random() < 0.5 else p[::-1])) for k, p in cells.items()]
    table += [(unit[0, 0], polygon(cells[0, 0])), (1, None), (9, None), (9, b"x")]
    got = dict(rows(dissolve.dissolved(spark.createDataFrame(table, "unit int, geom binary"))))
    assert set(got) == {1, 2, 3, 9} and got[9] is None
    for k, p in cells.items():
        x, y = sum(v[0] for v in p) / 4, sum(v[1] for v in p) / 4
        assert [u for u in (1, 2, 3) if covers(got[u], x, y)] == [unit[k]]
    ring = lambda p: abs(geometry.ring_area(np.array([*p, p[0]])))
    for u in (1, 2, 3):
        parts = geometry.rings_of(got[u])
        assert sum(geometry.ring_area(r) for p in parts for r in p) == pytest.approx(sum(ring(p) for k, p in cells.items() if unit[k] == u), rel=1e-12)
        # rings touch no vertex twice, and holes lie in their polygon
        assert all(len({tuple(v) for v in r}) == len(r) - 1 for p in parts for r in p)
        assert all(dissolve._inside(*((h[0] + h[1]) / 2), p[0]) for p in parts for h in p[1:])
        kept = {tuple(v) for p in parts for r in p for v in r}
        inside = {(c, r) for c in range(1, size) for r in range(1, size) if all(unit[c - i, r - j] == u for i in (0, 1) for j in (0, 1))}
        assert not kept & {at[k] for k in inside}


def test_merged_holes_islands_and_snap(spark):
    outer = [(0, 0), (9, 0), (9, 9), (0, 9)]
    hole, island = [(2, 2), (7, 2), (7, 7), (2, 7)], [(4, 4), (5, 4), (5, 5), (4, 5)]
    table = [("a", polygon(outer, hole)), ("a", polygon(island)), ("b", polygon(outer, hole)), ("b", polygon(hole)), ("c", polygon([(0, 0), (1, 0), (1, 1), (0, 1)])), ("c", polygon([(1.0000001, 0), (2, 0), (2, 1), (1.0000001, 1)])), (None, polygon(island))]
    frame = spark.createDataFrame(table, "unit string, geom binary")
    summary = lambda df: {r.unit: (r.s["area"], r.s["outers"], r.s["holes"], r.s["points"]) for r in df.withColumn("s", geometry.polygon_summary("geom")).collect()}
    got = summary(dissolve.dissolved(frame))
    assert got["a"] == (57.0, 2, 1, 12) and got["b"] == (81.0, 1, 0, 4) and got[None] == (1.0, 1, 0, 4)
    assert got["c"][1] == 2 and summary(dissolve.dissolved(frame, snap=0.001))["c"] == (2.0, 1, 0, 6)
    assert dissolve.dissolved(frame.where("false")).collect() == []
    assert summary(dissolve.dissolved(frame.where("unit = 'a'").withColumn("ring", F.lit(1)))) == {"a": got["a"]}


# ---- main stems


def tree(seed, n=120):
    """n, to, length, area with targets that are not there, a cycle, equal drainage and lines without length."""
    rng = random.Random(seed)
    out = [(k, rng.randrange(max(0, k - 6), k) if k and rng.random() < 0.97 else rng.choice([None, 9999]), float(rng.randrange(5)) * 100, rng.randrange(1, 4)) for k in range(n)]
    return [*out, (500, 501, 100.0, 1), (501, 502, 200.0, 1), (502, 500, 300.0, 5)]


FLOW = "n bigint, to bigint, length double, area bigint"


def stems_of(table):
    """n: (to, stem, place, reach), and the main inflow of each line."""
    to = {n: t for n, t, _, _ in table}
    to = {n: t if t in to else None for n, t in to.items()}
    to[500] = None  # the cycle ends on its smallest line
    size = {n: (length, area) for n, _, length, area in table}
    total = {n: 0 for n in to}
    for n in to:
        at = n
        while at is not None:
            total[at] += size[n][1]
            at = to[at]
    main = {}
    for n in sorted(to):
        t = to[n]
        if t is not None and (t not in main or total[n] > total[main[t]]):
            main[t] = n
    out = {}
    for n in to:
        at, place, reach = n, 1, size[n][0]
        while to[at] is not None and main[to[at]] == at:
            at, place = to[at], place + 1
            reach += size[at][0]
        out[n] = (to[n], at, place, reach)
    return out, main


@pytest.mark.parametrize("seed", range(1))
def test_main_stems_and_units_along_them(spark, seed):
    table = tree(seed)
    frame = spark.createDataFrame(table, FLOW)
    want, main = stems_of(table)
    assert {r.n: (r.to, r.stem, r.place, r.reach) for r in network.main_stems(frame).collect()} == want

    size = {n: (length, float(area)) for n, _, length, area in table}
    ideal, least_area, least_length = 6.0, 3.0, 500.0
    ends = set()
    for head in (n for n in want if n not in main):
        at, length, area = head, 0.0, 0.0
        while True:
            length, area = length + size[at][0], area + size[at][1]
            if length >= least_length and area >= ideal:
                ends.add(at)
                length = area = 0.0
            to = want[at][0]
            if to is None or main[to] != at:
                if length >= least_length and area >= least_area:
                    ends.add(at)
                break
            at = to

    def unit(n):
        while n not in ends and want[n][0] is not None:
            n = want[n][0]
        return n

    units = {}
    for n in want:
        u = units.setdefault(unit(n), [0.0, 0.0, 0])
        u[0] += size[n][1]
        u[1] += size[n][0] if want[n][1] == want[unit(n)][1] else 0.0
        u[2] += 1
    got = {r.unit: (r.to_unit, r.area, r.length, r.members) for r in stems.aggregate_along_stems(frame, ideal, least_area, least_length).collect()}
    assert got == {u: (None if want[u][0] is None else unit(want[u][0]), *v) for u, v in units.items()}
    assert all(v[1] >= least_area and v[2] >= least_length for u, v in got.items() if v[0] is not None)


def test_collapse_with_a_length_for_main_stems(spark):
    # 3 and 4 meet in 2, and 3 has more drainage
    frame = spark.createDataFrame([(1, None, 900.0, 1), (2, 1, 900.0, 1), (3, 2, 600.0, 5), (4, 2, 600.0, 1)], FLOW)
    ids = lambda *a: {r.n: r.members for r in network.collapse_short_lines(frame, *a).collect()}
    assert ids(500.0) == {1: 1, 2: 1, 3: 1, 4: 1} and ids(500.0, 700.0) == {1: 1, 2: 2, 4: 1} and ids(700.0, 500.0) == {1: 1, 2: 2, 3: 1}


def test_preparation_steps_with_geometry(spark):
    shape = [line([(0, -k), (0, -k - 1)]) for k in range(4)]
    frame = spark.createDataFrame([(k, k + 1 if k < 3 else None, 1000.0, 2, shape[k]) for k in range(4)], FLOW + ", geom binary")
    squares = spark.createDataFrame([(k, polygon([(0, k), (1, k), (1, k + 1), (0, k + 1)])) for k in range(4)], "n bigint, geom binary")
    settings = plan.Settings(split=600.0, collapse=10.0, collapse_main=20.0, ideal_area=4.0, least_length_km=1.5)
    layers = plan.distribute(plan.refactor({"lines": frame, "line-divides": squares}, settings), settings)
    assert layers["parts"].count() == 8 and layers["parts"].where("geom IS NULL").count() == 0
    units = {r.unit: (r.to_unit, r.area, r.length) for r in layers["units"].collect()}
    assert units == {1: (3, 4.0, 2000.0), 3: (None, 4.0, 2000.0)}
    assert {r.unit: r.s["area"] for r in layers["unit-divides"].withColumn("s", geometry.polygon_summary("geom")).collect()} == {1: 2.0, 3: 2.0}


# ---- interval index


def search(pairs, outlets, sibling):
    """What flows into the outlets, and with sibling into the nodes they flow into."""
    to, found = dict(pairs), set(outlets)
    todo = [*outlets, *({to[o] for o in outlets if o in to} if sibling else ())]
    while todo:
        at = todo.pop()
        more = {n for n, t in pairs if t == at} - found
        found |= more
        todo += more
    return sorted((n,) for n in found)


@pytest.mark.parametrize("few", [256, 1])
def test_intervals_find_what_a_search_finds(spark, few, monkeypatch, tmp_path):
    rng = random.Random(4)
    pairs = [(k, rng.randrange(max(0, k - 9), k)) for k in range(1, 300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (1003, 1000)]
    edges = spark.createDataFrame([*pairs, pairs[0], (None, 3), (2000, None)], "fn bigint, tn bigint")
    path = f"file://{tmp_path}/index"
    monkeypatch.setattr(intervals, "STRETCH", 2)
    intervals.write_index(edges, path)
    index = intervals.read_index(spark, path)
    got = {r.node: (r.first, r["last"]) for r in index.collect()}
    assert sorted(f for f, _ in got.values()) == list(range(1, len(got) + 1)) and got[2000][0] == got[2000][1]
    assert got[1000][1] - got[1000][0] == 3  # the cycle is cut behind its smallest node
    monkeypatch.setattr(intervals, "RANGES", few)
    for wanted, sibling in (([7, 12, 60], False), ([299, 298, 11], True), ([5, 4444], True), ([0], False)):
        outlets = spark.createDataFrame([(w,) for w in [*wanted, None]], "node bigint")
        assert sorted(rows(intervals.upstream(index, outlets, sibling))) == search(pairs, wanted, sibling), (wanted, sibling)
    assert intervals.upstream(index, outlets.where("false")).collect() == []


def test_intervals_agree_with_the_upstream_search(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("fn"), F.floor(F.col("id") / 3).alias("tn"))
    outlets = spark.createDataFrame([(2,), (4,)], "node bigint")
    index = intervals.interval_index(edges)
    assert rows(intervals.upstream(index, outlets, True)) == rows(graph.upstream(edges, outlets, True))


def test_ranges_reach_the_scan(spark, tmp_path):
    edges = spark.range(1, 4000).select(F.col("id").alias("fn"), F.floor(F.col("id") / 2).alias("tn"))
    path = f"file://{tmp_path}/index"
    intervals.write_index(edges, path)
    found = intervals.upstream(intervals.read_index(spark, path), spark.createDataFrame([(5,), (40,)], "node bigint"))
    text = found._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters") :].splitlines()[0]
    assert "GreaterThanOrEqual(first," in pushed and "LessThanOrEqual(first," in pushed and "ReadSchema: struct<node:bigint,first:bigint>" in text


def test_intervals_need_one_way_down(spark):
    with pytest.raises(ValueError):
        intervals.interval_index(spark.createDataFrame([(1, 2), (1, 3)], "fn bigint, tn bigint"))


# ---- many rows at once, and tables that grow


def test_lines_of_a_batch_are_cut_at_once(monkeypatch):
    rng, alone = random.Random(4), geometry.cut_line_of
    lines = [line([(float(rng.randrange(9)), rng.uniform(0, 9)) for _ in range(rng.randrange(2, 9))]) for _ in range(300)]
    parts = [rng.randrange(2, 12) for _ in lines]
    want = [alone(g, n) for g, n in zip(lines, parts)]
    odd = [None, b"", line([(1, 1), (1, 1)]), line([(0, 0), (float("nan"), 1)]), line([(2, 2)]), line([(0, 0), (1, 1)]) + b"x"]
    assert geometry.cut_lines_of([*lines, *odd], [*parts, *[3] * len(odd)]) == want + [alone(g, 3) for g in odd]
    monkeypatch.setattr(geometry, "cut_line_of", None)
    assert geometry.cut_lines_of(lines, parts) == want


@pytest.mark.parametrize("pairs", [1, 7, 1 << 21])
def test_holes_find_their_ring_by_few_edges(monkeypatch, pairs):
    monkeypatch.setattr(dissolve, "PAIRS", pairs)
    rng = random.Random(pairs)
    for _ in range(20):
        boxes = [(rng.randrange(40), rng.randrange(40), rng.choice([1, 3, 9, 30])) for _ in range(rng.randrange(3, 40))]
        rings = [np.array([(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)], float) for x, y, w in boxes]
        points = np.array([(rng.randrange(80) / 2, rng.randrange(80) / 2) for _ in range(30)])
        want = [next((k for k, r in enumerate(rings) if dissolve._inside(*p, r)), -1) for p in points]
        assert dissolve._first_around(points, rings).tolist() == want


def test_tables_of_lines_are_not_broadcast(spark):
    frame = spark.createDataFrame([(k, k // 2 if k else None, float(k % 5), k % 3 + 1) for k in range(30)], "n bigint, to bigint, length double, area bigint")
    edges = frame.select(F.col("n").alias("fn"), F.col("to").alias("tn"))
    for made in (network.total_drainage(frame), network.main_stems(frame), stems.aggregate_along_stems(frame, 9.0, 3.0, 4.0), intervals.interval_index(edges)):
        plan_of = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan_of and "Broadcast" not in plan_of
