"""Grids as cell tables (col, row, value, further keys) and polygons over them."""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.geometry import MULTIPOLYGON, parse, write_many, write_polygon
from tarnworks.operators import tiles
from tarnworks.operators.aggregates import ZONAL, weighted_mode
from tarnworks.session import by_key


def grid_names(spark, names: list[str], layers: list[int]) -> DataFrame:
    """name, layer, path: every variable by every layer."""
    table = spark.createDataFrame([(n,) for n in names], "name string").select("name", F.explode(F.array(*map(F.lit, layers))).alias("layer"))
    return table.withColumn("path", F.format_string("%s_stag=%d.tif", "name", "layer"))


def stacked(grids: dict[str, DataFrame]) -> DataFrame:
    """Grids under one another with the name of each."""
    return reduce(DataFrame.unionByName, [g.withColumn("name", F.lit(n)) for n, g in grids.items()])


def mosaic(tiles: DataFrame) -> DataFrame:
    """col, row, value of overlapping tiles: the last tile (by ``tile``) with a value wins."""
    return tiles.groupBy("col", "row").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("tile"))).alias("value"))


def terrain(cells: DataFrame, size: float = 1.0, tile: int = 256) -> DataFrame:
    """col, row, slope, aspect in degrees from the eight neighbours; cells without all of them have none.

    The aspect is the direction that the slope faces, clockwise from north, null where it is level. Tiles are worked on as dense blocks
    with a rim, so a cell is shuffled once. Null and NaN are no data; of a cell that stands several times the largest value counts.
    """
    return tiles.terrain(cells, size, tile)


def zonal(covered: DataFrame, fun: str, keys: list[str], name: str) -> DataFrame:
    """An aggregate of covered cells (keys, value, coverage): mean, geometric_mean, circular_mean or mode."""
    if fun == "mode":
        return weighted_mode(covered, keys, "value", "coverage", name)
    return covered.groupBy(*keys).agg(ZONAL[fun](F.col("value"), F.col("coverage")).alias(name))


def weight_grid(covered: DataFrame, grid: str) -> DataFrame:
    """divide_id, cell, coverage, grid_id: the cells of each zone with their weights."""
    return covered.groupBy("divide_id", "cell").agg(F.sum("coverage").alias("coverage")).withColumn("grid_id", F.lit(grid))


def _clip(ring: list[tuple[float, float]], axis: int, at: float, keep_above: bool) -> list[tuple[float, float]]:
    out = []
    for k, b in enumerate(ring):
        a = ring[k - 1]
        a_in, b_in = ((p[axis] >= at) == keep_above or p[axis] == at for p in (a, b))
        if a_in != b_in:
            t = (at - a[axis]) / (b[axis] - a[axis])
            cut = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
            cut[axis] = at
            out.append(tuple(cut))
        if b_in:
            out.append(b)
    return out


def _band(ring: list[tuple[float, float]], axis: int, low: float, high: float) -> list[tuple[float, float]]:
    ring = _clip(ring, axis, low, True) if ring else ring
    return _clip(ring, axis, high, False) if ring else ring


def _rings(geom: bytes | None) -> list[tuple[int, list[tuple[float, float]]]]:
    """The rings of all polygons; the sign is -1 for holes."""
    shape, out = parse(geom), []
    todo = [shape] if shape else []
    while todo:
        kind, parts = todo.pop()
        if kind > 3:
            todo += parts
        elif kind == 3:
            out += [(-1 if k else 1, ring) for k, ring in enumerate(parts)]
    return out


def _area(ring: list[tuple[float, float]]) -> float:
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


def covered_cells(geom: bytes | None, tile_x: int, tile_y: int, tile: int, size: float) -> list[tuple[int, int, float]]:
    """col, row and the share that polygons cover, exactly, for the covered cells of one tile; holes count against.

    A ring is cut to the tile, then to each row of cells, then to the cells of the row.
    """
    areas, (c0, r0) = {}, (tile_x * tile, tile_y * tile)
    for sign, ring in _rings(geom):
        ring = _band(_band(ring, 0, c0 * size, (c0 + tile) * size), 1, r0 * size, (r0 + tile) * size)
        ys = [y for _, y in ring] or [0.0]
        for row in range(max(r0, math.floor(min(ys) / size)), min(r0 + tile, math.ceil(max(ys) / size))):
            strip = _band(ring, 1, row * size, (row + 1) * size)
            xs = [x for x, _ in strip] or [0.0]
            for col in range(max(c0, math.floor(min(xs) / size)), min(c0 + tile, math.ceil(max(xs) / size))):
                areas[col, row] = areas.get((col, row), 0.0) + sign * _area(_band(strip, 0, col * size, (col + 1) * size))
    return [(col, row, area / (size * size)) for (col, row), area in areas.items() if area > 0]


#: Tiles along the side of a range that is covered as a whole, at most, so that large ranges are several rows.
MOST_SPAN = 16


def _reduced(ring: list[tuple[float, float]], box: tuple[float, float, float, float]) -> list[tuple[float, float]]:
    """A clipped ring without vertices between two others on one side of the box; empty if it only runs along the box around nothing, its corners if around it all."""
    x0, y0, x1, y1 = box
    # a corner that stands twice would count as amid either side
    ring = [v for k, v in enumerate(ring) if v != ring[k - 1]]
    sides = [(x == x0) | (x == x1) << 1 | (y == y0) << 2 | (y == y1) << 3 for x, y in ring]
    ring = [v for k, v in enumerate(ring) if not sides[k - 1] & sides[k] & sides[(k + 1) % len(ring)]]
    sides = [(x == x0) | (x == x1) << 1 | (y == y0) << 2 | (y == y1) << 3 for x, y in ring]
    if all(sides[k - 1] & sides[k] for k in range(len(ring))):
        around = _area(ring) / ((x1 - x0) * (y1 - y0))
        return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)] if around > 0.5 else []
    return ring


def cover(geom: bytes | None, tile: int, size: float) -> list[tuple[int, int, int, bytes | None]]:
    """x, y, span, piece: the parts of polygons over square ranges of tiles, ``span`` a side; a null piece covers its range as a whole.

    A quad-tree: each block hands its quarters what it has clipped, so a vertex is clipped once a level, and blocks that
    polygons leave out or fill are not gone into.
    """
    polygons: list[list[tuple[int, list[tuple[float, float]]]]] = []
    for sign, ring in _rings(geom):
        if sign > 0:
            polygons.append([])
        polygons[-1].append((sign, ring))
    points = [v for p in polygons for _, r in p for v in r if all(map(math.isfinite, v))]
    if not points or len(points) < sum(len(r) for p in polygons for _, r in p):
        return []
    first, last = ([math.floor(f(v[axis] for v in points) / (size * tile)) for axis in (0, 1)] for f in (min, max))
    span = 1 << (max(b - a for a, b in zip(first, last))).bit_length()
    todo, out = [(*first, span, polygons)], []
    while todo:
        x, y, span, inside = todo.pop()
        box = tuple(v * tile * size for v in (x, y, x + span, y + span))
        clipped = []
        for polygon in inside:
            rings = [(sign, _reduced(_band(_band(ring, 0, box[0], box[2]), 1, box[1], box[3]), box)) for sign, ring in polygon]
            if any(ring for _, ring in rings):
                clipped.append([(sign, ring) for sign, ring in rings if ring or sign > 0])
        if not clipped:
            continue
        corners = [(box[0], box[1]), (box[2], box[1]), (box[2], box[3]), (box[0], box[3])]
        full = len(clipped) == 1 and len(clipped[0]) == 1 and clipped[0][0][1] == corners
        if full and span <= MOST_SPAN:
            out.append((x, y, span, None))
        elif span == 1:
            shapes = [write_polygon([[*r, *r[:1]] for _, r in p]) for p in clipped]
            out.append((x, y, 1, write_many(MULTIPOLYGON, shapes)))
        else:
            half = span // 2
            todo += [(x + i * half, y + j * half, half, clipped) for i in (0, 1) for j in (0, 1)]
    return out


def overlay(zones: DataFrame, cells: DataFrame, size: float = 1.0, tile: int = 64) -> DataFrame:
    """The zones' columns without geom, coverage, and the cells' columns, for every cell that a zone covers in part.

    Cell (col, row) is the square from (col, row) * size. A zone is cut to pieces by a quad-tree of tiles (``tile`` by
    ``tile`` cells); ranges that it fills are plain sequences, and only tiles on its border are cut to cells. The
    cells then meet the grid in an equality join, by shuffle: Spark counts a zone's cells as one row and would broadcast them.
    Null and odd geometries cover nothing.
    """

    @F.pandas_udf("array<struct<x: bigint, y: bigint, span: bigint, piece: binary>>")
    def pieces(geom: pd.Series) -> pd.Series:
        return pd.Series([cover(g, tile, size) for g in geom])

    @F.pandas_udf("array<struct<_first: bigint, _last: bigint, _row: bigint, coverage: double>>")
    def found(piece: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([[(col, col, row, v) for col, row, v in covered_cells(g, a, b, tile, size)] for g, a, b in zip(piece, x, y)])

    zone = [F.col(f"`{c}`") for c in zones.columns if c != "geom"]
    # dealt by tile, so that the pieces of one large zone are many tasks
    cut = zones.select(*zone, F.explode(pieces("geom")).alias("_cut")).repartition("_cut.x", "_cut.y")

    def along(c: str) -> tuple[Column, Column]:
        return F.col(f"_cut.{c}") * tile, (F.col(f"_cut.{c}") + F.col("_cut.span")) * tile - 1

    filled = F.transform(F.sequence(*along("y")), lambda row: F.struct(along("x")[0].alias("_first"), along("x")[1].alias("_last"), row.alias("_row"), F.lit(1.0).alias("coverage")))
    # runs of cells in a row, of both kinds in one column: two filters of ``cut`` would cut the zones twice
    runs = cut.select(*zone, F.explode(F.when(F.col("_cut.piece").isNull(), filled).otherwise(found("_cut.piece", "_cut.x", "_cut.y"))).alias("_run"))
    covered = runs.select(*zone, F.explode(F.sequence("_run._first", "_run._last")).alias("_col"), "_run._row", "_run.coverage")
    # covered cells are on the left, whose rows a merge join does not hold
    met = covered.join(by_key(cells), (F.col("col") == F.col("_col")) & (F.col("row") == F.col("_row")))
    return met.drop("_col", "_row")
