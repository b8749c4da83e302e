"""The quad-tree cover of polygons against cutting the whole polygon to every tile."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tarnworks.functions import geometry
from tarnworks.operators import raster
from tarnworks.plans import preparation as plan


def star(seed, n, radius, x=0.0, y=0.0, least=0.6):
    rng = random.Random(seed)
    ring = [(x + radius * (s := rng.uniform(least, 1)) * math.cos(2 * math.pi * k / n), y + radius * s * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [*ring, ring[0]]


def whole(geom, tile, size):
    """Every cell's share, each tile cut from the whole polygon."""
    box, out = geometry.bounds_of(geom), {}
    x0, y0, x1, y1 = (math.floor(v / (size * tile)) for v in box)
    for x in range(x0, x1 + 1):
        for y in range(y0, y1 + 1):
            out |= {(c, r): v for c, r, v in raster.covered_cells(geom, x, y, tile, size)}
    return out


def by_cover(geom, tile, size):
    out = {}
    for x, y, span, piece in raster.cover(geom, tile, size):
        if piece is None:
            cells = [(c, r, 1.0) for c in range(x * tile, (x + span) * tile) for r in range(y * tile, (y + span) * tile)]
        else:
            assert span == 1
            cells = raster.covered_cells(piece, x, y, tile, size)
        for c, r, v in cells:
            assert (c, r) not in out
            out[c, r] = v
    return out


def same(a, b):
    small = 1e-9
    assert {k for k, v in a.items() if v > small} == {k for k, v in b.items() if v > small}
    assert all(v == pytest.approx(b.get(k, 0), abs=1e-9) for k, v in a.items())


@pytest.mark.parametrize("tile,size", [(1, 1.0), (4, 1.0), (8, 0.7), (64, 3.0)])
def test_cover_against_every_tile(tile, size):
    shapes = [
        geometry.write_polygon([star(1, 40, 30.0)]),
        geometry.write_polygon([star(2, 25, 40.0, -7.3, 5.1), star(3, 12, 15.0, -7.3, 5.1)[::-1]]),
        geometry.write_polygon([[(0.0, 0.0), (32.0, 0.0), (32.0, 32.0), (0.0, 32.0), (0.0, 0.0)], [(8.0, 8.0), (8.0, 16.0), (16.0, 16.0), (16.0, 8.0), (8.0, 8.0)]]),
        # a comb, whose teeth leave a tile and come back
        geometry.write_polygon([[(0.0, 0.0), *[(float(k), 30.0 if k % 2 else 3.0) for k in range(1, 30)], (30.0, 0.0), (0.0, 0.0)]]),
    ]
    shapes.append(struct.pack("<BII", 1, geometry.MULTIPOLYGON, 2) + shapes[0] + geometry.write_polygon([star(4, 9, 5.0, 60.0, 60.0)]))
    for shape in shapes:
        same(whole(shape, tile, size), by_cover(shape, tile, size))


def test_odd_geometries_cover_nothing():
    flat = geometry.write_polygon([[(1.0, 1.0), (3.0, 1.0), (1.0, 1.0)]])
    nan = geometry.write_polygon([[(0.0, 0.0), (float("nan"), 1.0), (2.0, 2.0), (0.0, 0.0)]])
    for shape in (None, b"", b"\x01", struct.pack("<BIdd", 1, 1, 0, 0), geometry.write_polygon([]), nan):
        assert raster.cover(shape, 4, 1.0) == []
    assert by_cover(flat, 4, 1.0) == {}


def test_work_follows_the_border():
    geom, tile = geometry.write_polygon([star(5, 20000, 2000.0, least=0.98)]), 16
    made = raster.cover(geom, tile, 1.0)
    border = [m for m in made if m[3] is not None]
    kept = sum(len(ring) for m in border for _, ring in raster._rings(m[3]))
    # of some 50,000 tiles in its box, only those on the border are cut, each from its own stretch
    assert len(border) < 4000 and kept < 4 * 20000 and len(made) < 3 * len(border)
    area = sum(m[2] ** 2 * tile**2 for m in made if m[3] is None) + sum(s * raster._area(r) for m in border for s, r in raster._rings(m[3]))
    assert area == pytest.approx(raster._area(raster._rings(geom)[0][1]))


def test_overlay_keeps_columns(spark):
    zones = spark.createDataFrame([("a", 1, geometry.write_polygon([star(6, 30, 20.0)])), ("b", 2, None), (None, 3, geometry.write_polygon([star(7, 5, 3.0, 9.0)]))], "x string, span int, geom binary")
    cells = spark.createDataFrame([(c, r, c * r) for c in range(-21, 21) for r in range(-21, 21)], "col int, row int, piece int")
    out = raster.overlay(zones, cells, tile=4)
    assert sorted(out.columns) == ["col", "coverage", "piece", "row", "span", "x"]
    got = {}
    for r in out.collect():
        got.setdefault((r.x, r.span), {})[r.col, r.row] = r.coverage
    same(got["a", 1], whole(geometry.write_polygon([star(6, 30, 20.0)]), 64, 1.0))
    same(got[None, 3], whole(geometry.write_polygon([star(7, 5, 3.0, 9.0)]), 64, 1.0))
    assert len(got) == 2


def test_what_divides_cover_is_not_broadcast(spark):
    corner = [(F.col("id") % m + d).cast("double") for m, d in ((40, 0.25), (30, 0.5), (40, 9.75), (30, 9.5))]
    divides = spark.range(60).select(F.col("id").alias("divide_id"), geometry.rectangle(*corner).alias("geom"))
    cells = spark.range(2500).select((F.col("id") % 50).alias("col"), F.floor(F.col("id") / 50).alias("row"), (F.col("id") % 7).alias("value"))
    layers = plan.add_zonal_attributes({"divide-attributes": divides.select("divide_id")}, divides, cells, {"mean": "mean", "mode": "mode"}, tile=4)
    made, covered = layers["divide-attributes"], raster.overlay(divides, cells, tile=4)
    assert {r.divide_id: (r.x, r.y) for r in made.collect()} == {k: (k % 40 + 5.0, k % 30 + 5.0) for k in range(60)}
    total = {r.divide_id: r.s for r in covered.groupBy("divide_id").agg(F.sum("coverage").alias("s")).collect()}
    assert total == {k: pytest.approx(9.5 * 9.0) for k in range(60)}
    for frame in (made, covered):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    # of a zone, the tiles that it fills and those on its border come from one cut
    assert covered._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [pieces(") == 1
