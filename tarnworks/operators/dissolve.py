"""Merging polygons to units by cancelling their common edges.

Rings run counterclockwise around polygons and clockwise around holes, so a polygon is always to
the left of its edges. Where two polygons of one unit meet, their edges run against each
other and cancel in an aggregate; what is left bounds the unit. These edges are chained to
rings: the next edge is the first one clockwise at the vertex, and pointers double along it, which takes
log2(edges of a ring) rounds of a join each. Orientation tells holes.

Neighbours must have the vertices of their common border in common, as the polygons of a
coverage do; with ``snap`` coordinates are first rounded to multiples of it. Overlapping polygons are not cut:
an edge that both have in the same direction counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.functions.geometry import MULTIPOLYGON, plain_polygons, ring_area, rings_of, write_many, write_polygon
from tarnworks.session import by_key, staged

_ENDS = ["ax", "ay", "bx", "by"]


def directed_edges(polygons: DataFrame, snap: float | None = None) -> DataFrame:
    """unit, ax, ay, bx, by, sign: every edge from its smaller to its larger end, and 1 if it runs so, -1 if not; polygons: unit, geom."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found = [], []
            geoms = batch.column(1).to_pylist()
            plain, rest = plain_polygons(geoms)
            for k in rest:
                plain += [(np.array([k]), r[None]) for p in rings_of(geoms[k]) or [] for r in p]
            for places, rings in plain:
                rings = np.round(rings / snap) * snap + 0.0 if snap else rings
                owner.append(np.repeat(places, rings.shape[1] - 1))
                found.append(np.concatenate([rings[:, :-1], rings[:, 1:]], axis=2).reshape(-1, 4))
            if found:
                sides, owner = np.concatenate(found), np.concatenate(owner)
                long = (sides[:, :2] != sides[:, 2:]).any(axis=1)
                sides, owner = sides[long], owner[long]
                back = (sides[:, 0] > sides[:, 2]) | ((sides[:, 0] == sides[:, 2]) & (sides[:, 1] > sides[:, 3]))
                sides[back] = sides[back][:, [2, 3, 0, 1]]
                columns = [batch.column(0).take(pa.array(owner)), *(pa.array(c) for c in np.ascontiguousarray(sides.T)), pa.array(np.where(back, -1, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=["unit", *_ENDS, "sign"])

    kind = polygons.schema["unit"].dataType.simpleString()
    return polygons.select("unit", "geom").mapInArrow(edges, f"unit {kind}, ax double, ay double, bx double, by double, sign bigint")


def boundary_edges(polygons: DataFrame, snap: float | None = None) -> DataFrame:
    """unit, ax, ay, bx, by: the edges that bound the units, with the unit to their left."""
    # not a sum: an edge of a polygon that stands twice still cancels with its neighbour's
    left = directed_edges(polygons, snap).groupBy("unit", *_ENDS).agg(F.min("sign").alias("sign"), F.max("sign").alias("other")).where("sign = other")
    turned = dict(zip(_ENDS, ["bx", "by", "ax", "ay"]))
    return left.select("unit", *[F.when(F.col("sign") > 0, F.col(c)).otherwise(F.col(turned[c])).alias(c) for c in _ENDS])


def _next_edges(edges: DataFrame) -> DataFrame:
    """n, next: at its end an edge goes on with the first edge clockwise from itself, so the unit stays to the left."""
    into = edges.select("unit", F.col("bx").alias("x"), F.col("by").alias("y"), F.atan2(F.col("ay") - F.col("by"), F.col("ax") - F.col("bx")).alias("angle"), F.col("n").alias("into"), F.lit(None).cast("bigint").alias("out"))
    out = edges.select("unit", F.col("ax").alias("x"), F.col("ay").alias("y"), F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")).alias("angle"), F.lit(None).cast("bigint").alias("into"), F.col("n").alias("out"))
    at = Window.partitionBy("unit", "x", "y")
    before = F.last("out", ignorenulls=True).over(at.orderBy("angle").rowsBetween(Window.unboundedPreceding, -1))
    around = F.max(F.when(F.col("out").isNotNull(), F.struct("angle", "out"))).over(at)
    return into.unionByName(out).withColumn("next", F.coalesce(before, around["out"])).where("into IS NOT NULL").select(F.col("into").alias("n"), "next")


def _ring_places(follows: DataFrame) -> DataFrame:
    """n, ring, left: the smallest edge of each edge's ring, and the edges from it to the end of the ring, itself included.

    low is the smallest of the 2^k edges from n on. When it equals that of the edge
    behind them everywhere, these stretches lie around a whole ring, so it is the ring's.
    """
    state = staged(follows.select("n", F.col("next").alias("at"), F.col("n").alias("low"), F.lit(True).alias("open")), "rings")
    while not state.where("open").isEmpty():
        ahead = state.select(F.col("n").alias("a_n"), F.col("at").alias("a_at"), F.col("low").alias("a_low"))
        grown = state.join(by_key(ahead), F.col("at") == F.col("a_n"))
        state = staged(grown.select("n", F.col("a_at").alias("at"), F.least("low", "a_low").alias("low"), (F.col("low") != F.col("a_low")).alias("open")), "rings")
    ring = state.select(F.col("n").alias("r_n"), F.col("low").alias("ring"))
    place = follows.join(by_key(ring), F.col("n") == F.col("r_n")).select("n", "ring", F.nullif("next", "ring").alias("at"), F.lit(1).cast("bigint").alias("left"))
    place = staged(place, "ring-places")
    while not place.where("at IS NOT NULL").isEmpty():
        ahead = place.select(F.col("n").alias("a_n"), F.col("at").alias("a_at"), F.col("left").alias("a_left"))
        grown = place.join(by_key(ahead), F.col("at") == F.col("a_n"), "left")
        place = staged(grown.select("n", "ring", F.col("a_at").alias("at"), (F.col("left") + F.coalesce("a_left", F.lit(0))).alias("left")), "ring-places")
    return place.select("n", "ring", "left")


def _simple(ring: np.ndarray) -> list[np.ndarray]:
    """A ring without its last vertex, cut where it touches itself, so that no vertex comes twice; closed."""
    stack, at, out = [], {}, []
    for v in map(tuple, ring.tolist()):
        if v in at:
            loop = stack[at[v] :]
            out.append(loop)
            for w in loop[1:]:
                del at[w]
            del stack[at[v] + 1 :]
        else:
            at[v] = len(stack)
            stack.append(v)
    return [np.array([*r, r[0]]) for r in [*out, stack] if len(r) > 2]


def _inside(x: float, y: float, ring: np.ndarray) -> bool:
    (x0, y0), (x1, y1) = ring[:-1].T, ring[1:].T
    cross = (y0 > y) != (y1 > y)
    return bool((x < x0[cross] + (y - y0[cross]) / (y1[cross] - y0[cross]) * (x1[cross] - x0[cross])).sum() % 2)


#: Pairs of a point and an edge that are looked at at once, about.
PAIRS = 1 << 21


def _first_around(points: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """The first of the closed rings that each point is inside of, or -1.

    A point is inside where an odd number of a ring's edges is to its right. Points are sorted by y, so those beside an edge are
    neighbours, and edges meet no others; points that have a ring leave.
    """
    if len(points) * len(rings) <= 16:
        return np.array([next((k for k, r in enumerate(rings) if _inside(*p, r)), -1) for p in points])
    out = np.full(len(points), -1)
    left = np.argsort(points[:, 1], kind="stable")
    sizes = np.array([len(r) - 1 for r in rings])
    ends = np.concatenate([np.concatenate([r[:-1], r[1:]], axis=1) for r in rings])
    of = np.repeat(np.arange(len(rings)), sizes)
    # a point to the right of a ring is to the right of all its edges
    most = np.repeat(np.maximum.reduceat(ends[:, 0], np.concatenate([[0], np.cumsum(sizes)[:-1]])), sizes)
    at = 0
    while at < len(ends) and len(left):
        ys = points[left, 1]
        # a batch of rings, or one large one by stretches of its edges
        stop = min(len(ends), at + PAIRS)
        low, high = np.sort(ends[at:stop, 1::2], axis=1).T
        first = np.searchsorted(ys, low, "left")
        beside = np.searchsorted(ys, high, "left") - first
        total = np.cumsum(beside)
        stop = at + max(1, int(np.searchsorted(total, PAIRS, "right")))
        begins = np.searchsorted(of, of[at], "left")
        whole = stop if stop == len(ends) or of[stop] != of[stop - 1] else int(np.searchsorted(of, of[stop - 1], "left"))
        if whole > begins:
            stop = whole
            odd = _crossings(points, left, ends[at:stop], most[at:stop], of[at:stop], first[: stop - at], beside[: stop - at])
        else:
            stop, odd = int(np.searchsorted(of, of[at], "right")), np.empty((2, 0), int)
            for a in range(at, stop, max(1, PAIRS // max(1, len(left)))):
                b = min(stop, a + max(1, PAIRS // max(1, len(left))))
                low, high = np.sort(ends[a:b, 1::2], axis=1).T
                first = np.searchsorted(ys, low, "left")
                some = _crossings(points, left, ends[a:b], most[a:b], of[a:b], first, np.searchsorted(ys, high, "left") - first)
                odd = _odd(np.concatenate([odd, some], axis=1))
        ring, point = odd
        # rings come in order, so the first one stays
        order = np.lexsort((ring, point))
        point, ring = point[order], ring[order]
        once = np.concatenate([[True], point[1:] != point[:-1]]) if len(point) else np.empty(0, bool)
        out[point[once]] = ring[once]
        left = left[out[left] < 0]
        at = stop
    return out


def _odd(pairs: np.ndarray) -> np.ndarray:
    """The columns that stand there an odd number of times, once each."""
    if not pairs.shape[1]:
        return pairs
    found, counts = np.unique(pairs, axis=1, return_counts=True)
    return found[:, counts % 2 == 1]


def _crossings(points: np.ndarray, left: np.ndarray, ends: np.ndarray, most: np.ndarray, of: np.ndarray, first: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """ring, point of the points with an odd number of edges to their right; edge k is beside points first[k] on of ``left``."""
    edge = np.repeat(np.arange(len(ends)), beside)
    point = left[np.arange(len(edge)) - np.repeat(np.cumsum(beside) - beside, beside) + np.repeat(first, beside)]
    near = points[point, 0] < most[edge]
    edge, point = edge[near], point[near]
    x0, y0, x1, y1 = ends[edge].T
    x, y = points[point].T
    right = x < x0 + (y - y0) / (y1 - y0) * (x1 - x0)
    return _odd(np.stack([of[edge[right]], point[right]]))


def shape_of(rings: list[np.ndarray]) -> bytes | None:
    """A polygon, or a multi-polygon, of rings in order; each hole goes to the smallest outer ring around it."""
    rings = [(ring_area(s), s.min(axis=0).tolist(), s) for r in rings for s in _simple(r)]
    outers = [r for *_, r in sorted((r for r in rings if r[0] > 0), key=lambda r: r[:2])]
    holes = [r for *_, r in sorted((r for r in rings if r[0] < 0), key=lambda r: r[1])]
    parts = [[r] for r in outers]
    if holes and parts:
        around = np.zeros(len(holes), int) if len(parts) == 1 else _first_around(np.array([(h[0] + h[1]) / 2 for h in holes]), outers)
        for hole, part in zip(holes, around.tolist()):
            if part >= 0:
                parts[part].append(hole)
    return write_many(MULTIPOLYGON, [write_polygon([[tuple(v) for v in r.tolist()] for r in p]) for p in parts]) if parts else None


def dissolved(polygons: DataFrame, snap: float | None = None) -> DataFrame:
    """unit, geom: one polygon or multi-polygon for each unit of ``polygons`` (unit, geom).

    Null geometries and what is no polygon add nothing; a unit of such alone has a null geometry. Rows with a null unit form a
    unit of their own. A polygon that stands twice in a unit counts once.
    """
    edges = staged(boundary_edges(polygons, snap).withColumn("n", F.monotonically_increasing_id()), "dissolve-edges")
    places = _ring_places(staged(_next_edges(edges), "dissolve-next"))
    placed = edges.join(by_key(places.withColumnRenamed("n", "p_n")), F.col("n") == F.col("p_n"))
    # a unit's shape is one value of one row, so its vertices meet in a task in any case
    vertices = F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("k"), "ax", "ay")))
    rings = placed.groupBy("unit", "ring").agg(vertices.alias("v")).select("unit", F.struct(F.col("v.ax").alias("ax"), F.col("v.ay").alias("ay")).alias("r"))
    rings = rings.groupBy(F.col("unit").alias("r_unit")).agg(F.collect_list("r").alias("rings"))

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shape_of([np.array([r["ax"], r["ay"]]).T for r in rings.as_py()]) for rings in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["r_unit", "geom"])

    made = rings.mapInArrow(shapes, f"r_unit {polygons.schema['unit'].dataType.simpleString()}, geom binary")
    units = polygons.select("unit").distinct()
    return units.join(by_key(made), F.col("unit").eqNullSafe(F.col("r_unit")), "left").select("unit", "geom")


def merged_divides(divides: DataFrame, placed: DataFrame, snap: float | None = None) -> DataFrame:
    """unit, geom: the divides (n, geom) of the lines that each unit has taken (placed: n, at)."""
    own = placed.select(F.col("n").alias("p_n"), F.col("at").alias("unit"))
    return dissolved(divides.join(by_key(own), F.col("n") == F.col("p_n")).select("unit", "geom"), snap)
