"""Terrain and flow on tiles against plain loops over the whole grid."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tarnworks.operators import raster, tiles


def plain_flow(grid):
    """{cell: (outlet, number of cells through it)}, both null for cells that lead to a cycle."""
    out, through = {}, dict.fromkeys(grid, 0)
    for start in grid:
        cell, seen = start, []
        while cell is not None and cell not in seen:
            seen.append(cell)
            step = tiles.D8.get(grid[cell])
            ahead = (cell[0] + step[0], cell[1] + step[1]) if step else None
            last, cell = cell, ahead if ahead in grid else None
        out[start] = last if cell is None else None
        for c in seen:
            through[c] += 1
    return {c: (o, through[c] if o else None) for c, o in out.items()}


def frame(spark, grid, more=()):
    return spark.createDataFrame([(c, r, d, 7) for (c, r), d in [*grid.items(), *more]], "col int, row int, dir int, _tx int")


def check(spark, grid, tile, more=()):
    got = tiles.watersheds(frame(spark, grid, more), tile).collect()
    grid = {k: d for k, d in grid.items() if d is not None}
    assert len(got) == len(grid)
    found = {(r.col, r.row): (None if r.outlet_col is None else (r.outlet_col, r.outlet_row), r.upstream) for r in got}
    assert found == plain_flow(grid)


@pytest.mark.parametrize("seed,tile", [(1, 1), (2, 4), (3, 7), (4, 64)])
def test_watersheds_against_a_walk(spark, seed, tile):
    rng = random.Random(seed)
    codes = [1, 4, 2, 8, 1, 4, 16, 64, 128, 32, 0, None, 255]
    weights = [8, 8, 8, 4, 8, 8, 1, 1, 1, 1, 1, 1, 1]
    grid = {(c, r): rng.choices(codes, weights)[0] for c in range(-13, 12) for r in range(-9, 14)}
    check(spark, grid, tile)


def test_long_flows_cross_many_tiles(spark):
    # one flow winds through the whole grid, row by row; a ring of cells runs around the corner of four tiles, with a tail
    winding = {(c, r): (1 if r % 2 == 0 else 16) for c in range(20) for r in range(20)}
    winding |= {(19 if r % 2 == 0 else 0, r): 4 for r in range(19)}
    check(spark, winding, 3)
    assert max(v[1] for v in plain_flow(winding).values()) == 400
    ring = {(3, 3): 1, (4, 3): 4, (4, 4): 16, (3, 4): 64, (2, 3): 1, (1, 3): 1, (5, 5): 64, (5, 4): 4, (9, 9): 1, (10, 9): 1}
    check(spark, ring, 4)
    far = {(k - 2_000_000_000, 2_000_000_000 + k): 2 for k in range(9)}
    check(spark, far, 2)


def test_odd_grids(spark):
    assert tiles.watersheds(frame(spark, {(0, 0): 1}).limit(0)).collect() == []
    check(spark, {(0, 0): None, (1, 0): None}, 4)
    check(spark, {(0, 0): 1, (1, 0): 4}, 4, [((0, 0), 0), ((0, 0), None), ((1, 0), 1)])
    holes = frame(spark, {(0, 0): 1}).union(spark.createDataFrame([(None, 0, 1, 1), (0, None, 1, 1)], "col int, row int, dir int, _tx int"))
    assert [tuple(r) for r in tiles.watersheds(holes).collect()] == [(0, 0, 0, 0, 1)]


@pytest.mark.parametrize("tile", [1, 3, 256])
def test_terrain_against_a_loop(spark, tile):
    rng = random.Random(tile)
    z = {(c, r): rng.uniform(0, 9) for c in range(-6, 7) for r in range(-5, 6) if rng.random() < 0.97}
    data = [(c, r, v) for (c, r), v in z.items()] + [(20, 20, None), (21, 20, float("nan"))]
    data += [(30 + x, 30 + y, 1.0) for x in range(3) for y in range(3)] + [(31, 31, 0.5)]
    got = {(r.col, r.row): (r.slope, r.aspect) for r in raster.terrain(spark.createDataFrame(data, "col int, row int, value double"), 2.0, tile).collect()}
    want = {(31, 31): (0.0, None)}
    for c, r in z:
        near = {(x, y): z.get((c + x, r + y)) for x in (-1, 0, 1) for y in (-1, 0, 1)}
        if None not in near.values():
            e = sum(near[1, y] * w - near[-1, y] * w for y, w in ((-1, 1), (0, 2), (1, 1))) / 16
            s = sum(near[x, 1] * w - near[x, -1] * w for x, w in ((-1, 1), (0, 2), (1, 1))) / 16
            want[c, r] = (math.degrees(math.atan(math.hypot(e, s))), math.degrees(math.atan2(-e, s)) % 360)
    assert got.keys() == want.keys()
    for k, (slope, aspect) in want.items():
        assert got[k][0] == pytest.approx(slope) and got[k][1] == (None if aspect is None else pytest.approx(aspect))


def test_rows_are_shuffled_about_once(spark):
    cells = spark.range(128 * 128).select((F.col("id") % 128).alias("col"), F.floor(F.col("id") / 128).alias("row"))
    assert tiles.rimmed(cells, 64).count() <= 1.07 * 128 * 128
    plan = raster.terrain(cells.withColumn("value", F.lit(1.0)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
