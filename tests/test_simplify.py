"""Simplified polygons and lines against plain loops over the whole coverage."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.functions import geometry
from tarnworks.operators import dissolve, simplify
from tarnworks.plans import preparation as plan


def distance(p, a, b):
    square = (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2
    t = min(max(((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])) / square, 0), 1) if square else 0
    return math.dist(p, (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))


def recursive(points, tolerance):
    if len(points) < 3:
        return list(points)
    far = max(range(1, len(points) - 1), key=lambda k: distance(points[k], points[0], points[-1]))
    if distance(points[far], points[0], points[-1]) <= tolerance:
        return [points[0], points[-1]]
    return recursive(points[: far + 1], tolerance)[:-1] + recursive(points[far:], tolerance)


def wavy_grid(seed, size=5, steps=12, most=0.2):
    """A coverage of cells with wavy borders: {(c, r): ring}, and one cell that lies in a hole of the cell (1, 1)."""
    rng = random.Random(seed)

    def side(a, b):
        inner = [(a[0] + (b[0] - a[0]) * k / steps + rng.uniform(-1, 1) * most, a[1] + (b[1] - a[1]) * k / steps + rng.uniform(-1, 1) * most) for k in range(1, steps)]
        return [a, *inner, b]

    flat = {(c, r): side((c * 4.0, r * 4.0), (c * 4.0 + 4, r * 4.0)) for c in range(size) for r in range(size + 1)}
    tall = {(c, r): side((c * 4.0, r * 4.0), (c * 4.0, r * 4.0 + 4)) for c in range(size + 1) for r in range(size)}
    cells = {(c, r): [[*flat[c, r][:-1], *tall[c + 1, r][:-1], *flat[c, r + 1][:0:-1], *tall[c, r][:0:-1]]] for c in range(size) for r in range(size)}
    round_ = [(6 + (1 + rng.uniform(-0.05, 0.05)) * math.cos(k / 15 * math.pi), 6 + (1 + rng.uniform(-0.05, 0.05)) * math.sin(k / 15 * math.pi)) for k in range(30)]
    cells[1, 1].append(round_[::-1])
    cells[9, 9] = [round_[7:] + round_[:7]]
    return {k: [[*r, r[0]] for r in rings] for k, rings in cells.items()}


def table(spark, cells):
    return spark.createDataFrame([(c * 100 + r, geometry.write_polygon(rings)) for (c, r), rings in cells.items()], "unit bigint, geom binary")


@pytest.mark.parametrize("seed,tolerance", [(1, 0.15), (2, 0.4)])
def test_neighbours_do_not_part(spark, seed, tolerance):
    cells = wavy_grid(seed)
    made = {r.unit: geometry.rings_of(r.geom) for r in simplify.simplified(table(spark, cells), tolerance).collect()}
    before = {v for rings in cells.values() for ring in rings for v in ring}
    sides = {}
    for (c, r), rings in cells.items():
        ours = made[c * 100 + r][0]
        assert len(ours) == len(rings)
        for ring, simple in zip(rings, ours):
            left = [tuple(v) for v in simple.tolist()]
            assert set(left) <= set(ring) and len(left) < len(ring)
            assert all(min(distance(v, a, b) for a, b in zip(left, left[1:])) <= tolerance + 1e-12 for v in ring)
            for a, b in zip(left, left[1:]):
                sides[a, b] = sides.get((a, b), 0) + 1
    # every inner side runs once each way; the others bound the whole coverage
    assert set(sides.values()) == {1}
    outer = [s for s in sides if s[::-1] not in sides]
    area = sum(geometry.ring_area(r) for p in made.values() for q in p for r in q)
    assert area == pytest.approx(sum(a[0] * b[1] - a[1] * b[0] for a, b in outer) / 2)
    assert before >= {v for s in sides for v in s}
    # borders of two cells are what a recursive loop leaves of them
    border = [v for v in cells[2, 2][0][:13]]
    there = recursive(border, tolerance)
    kept = [tuple(v) for v in made[202][0][0].tolist()]
    assert set(there) == set(border) & set(kept)


def test_small_rings_stay(spark):
    cells = {(0, 0): [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)], [(4.0, 4.0), (4.0, 4.1), (4.1, 4.1), (4.1, 4.0), (4.0, 4.0)]]}
    cells[1, 0] = [cells[0, 0][1][::-1]]  # an island that tolerance would flatten
    cells[2, 0] = [[(10.0, 0.0), (10.2, 5.0), (10.0, 10.0), (10.0, 0.0)]]  # a sliver beside the square
    got = {r.unit: r.s for r in simplify.simplified(table(spark, cells), 1.0).select("unit", geometry.polygon_summary("geom").alias("s")).collect()}
    assert got[0].area == pytest.approx(99.99) and got[100].area == pytest.approx(0.01) and got[200].area == pytest.approx(1.0)
    assert (got[0].points, got[100].points, got[200].points) == (8, 4, 3)


def test_odd_polygons(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (1.0, 2.01), (0.0, 2.0), (0.0, 0.0)]
    flat = geometry.write_polygon([[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.0, 0.0)]])
    point = struct.pack("<BIdd", 1, 1, 0, 0)
    many = struct.pack("<BII", 1, geometry.MULTIPOLYGON, 2) + geometry.write_polygon([[(x + 10, y) for x, y in ring]]) + geometry.write_polygon([[(x + 20, y) for x, y in ring]])
    bad = geometry.write_polygon([[(0.0, 0.0), (float("nan"), 1.0), (2.0, 2.0), (0.0, 0.0)]])
    given = [("a", geometry.write_polygon([ring])), ("a", geometry.write_polygon([ring])), (None, None), ("p", point), ("f", flat), ("m", many), ("n", bad), ("e", b""), ("z", geometry.write_polygon([]))]
    polygons = spark.createDataFrame([(k, g, 1, 2) for k, g in given], "shape string, geom binary, x int, `x.y` int")
    out = simplify.simplified(polygons, 0.1)
    assert out.columns == polygons.columns and out.count() == len(given)
    got = {r["shape"]: r.geom for r in out.collect()}
    assert len(geometry.parse(got["a"])[1][0]) == 5 and [len(p[1][0]) for p in geometry.parse(got["m"])[1]] == [5, 5]
    assert got[None] is None and got["p"] is None and got["n"] is None and got["e"] is None and got["f"] is not None
    assert simplify.simplified(polygons.limit(0), 0.1).collect() == []


def test_simplified_units_still_merge(spark):
    cells = {k: v for k, v in wavy_grid(3).items() if k != (9, 9)}
    simple = simplify.simplified(table(spark, cells), 0.3)
    whole = simple.select(geometry.polygon_summary("geom").alias("s")).agg(F.sum("s.area")).first()[0]
    one = dissolve.dissolved(simple.withColumn("unit", F.lit(1))).select(geometry.polygon_summary("geom").alias("s")).first().s
    assert (one.outers, one.holes) == (1, 1) and one.area == pytest.approx(whole)


@pytest.mark.parametrize("seed", range(5))
def test_lines_against_recursion(seed):
    rng = random.Random(seed)
    points = [(float(k), rng.uniform(0, 3)) for k in range(200)]
    line = geometry.write_line(np.array(points))
    for tolerance in (0.0, 0.5, 2.0, 10.0):
        assert geometry.parse(geometry.simple_line_of(line, tolerance))[1] == recursive(points, tolerance)


def test_odd_lines(spark):
    loop = geometry.write_line(np.array([(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 0.0)]))
    assert geometry.parse(geometry.simple_line_of(loop, 1.0))[1] == [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 0.0)]
    two = struct.pack("<BII", 1, geometry.MULTILINE, 2) + loop + loop
    assert [len(p) for _, p in geometry.parse(geometry.simple_line_of(two, 6.0))[1]] == [3, 3]
    for bad in (None, b"", loop[:-3], struct.pack("<BIdd", 1, 1, 0, 0), geometry.write_line(np.array([(0.0, 0.0), (float("inf"), 1.0)]))):
        assert geometry.simple_line_of(bad, 1.0) is None
    lines = spark.createDataFrame([(1, None, 9000.0, 3, geometry.write_line(np.array([(0.0, 0.0), (4000.0, 300.0), (9000.0, 0.0)])))], "n bigint, to bigint, length double, area bigint, geom binary")
    for tolerance, points in ((400.0, 2), (0.0, 3)):
        parts = plan.refactor({"lines": lines}, plan.Settings(simplify=tolerance))["parts"]
        assert len(geometry.parse(parts.first().geom)[1]) == points


@pytest.mark.parametrize("tolerance", [0.3, 2.0, 6.0])
def test_a_batch_is_simplified_as_each_alone(monkeypatch, tolerance):
    rng, geoms, xs, ys = random.Random(6), [], [], []
    for k in range(400):
        ring = [(float(rng.randrange(7)), float(rng.randrange(7))) for _ in range(rng.randrange(3, 12))]
        ends = [v for v in ring if rng.random() < 0.4]
        geoms.append(geometry.write_polygon([[*ring, ring[0]] if k % 7 else ring]))
        xs.append(np.array([v[0] for v in ends]) if k % 5 else None)
        ys.append(np.array([v[1] for v in ends]) if k % 5 else None)
    want = [simplify.simplified_of(g, set() if x is None else set(zip(x.tolist(), y.tolist())), tolerance) for g, x, y in zip(geoms, xs, ys)]
    assert simplify.simplified_all(geoms, xs, ys, tolerance) == want
    square = geometry.write_polygon([[(0.0, 0.0), (2.0, 0.1), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]])
    monkeypatch.setattr(simplify, "simplified_of", None)
    made = simplify.simplified_all([square] * 3, [None] * 3, [None] * 3, 0.5)
    assert [(geometry.parse(g)[1], f) for g, f in made] == [([[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]], [])] * 3


def test_lines_of_a_batch_keep_what_each_alone_keeps():
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 5, 20, 70):
        lines = np.round(rng.uniform(0, 10, (60, size, 2)), 1)
        assert geometry.kept_alike(lines, 2.0).tolist() == [geometry.kept_vertices(v, 2.0).tolist() for v in lines]
