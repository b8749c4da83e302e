"""Simplifying polygons so that neighbours do not part.

Borders are cut to arcs at nodes, the vertices where borders meet. A vertex is none exactly when it stands between the same two
neighbours in every ring that passes it, so one window over vertices finds them all, and each polygon is
given those on its own rings. It then simplifies its arcs by itself: an arc runs in the same direction whichever polygon meets
it, so both sides of a border keep the same vertices, and no arc is chained or shuffled.

Neighbours must have the vertices of their common border in common, as in :mod:`tarnworks.operators.dissolve`. Arcs are
simplified one by one, so borders less than the tolerance apart can come to cross.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.functions.geometry import MULTIPOLYGON, kept_alike, kept_vertices, plain_polygons, polygons_of_rings, ring_area, ring_areas, rings_of, write_many, write_polygon
from tarnworks.session import by_key, staged

_NEAR = ["px", "py", "qx", "qy"]


def _open(ring: np.ndarray) -> np.ndarray:
    """A ring without its last vertex, and without vertices that follow their like."""
    return ring[:-1][(ring[1:] != ring[:-1]).any(axis=1)]


def _plain(geoms) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]:
    """Polygons of one ring without vertices that follow their like: places and open rings of those of as many vertices; and the places of all others."""
    alike, rest = plain_polygons(geoms)
    out = []
    for places, rings in alike:
        moves = (rings[:, 1:] != rings[:, :-1]).any(axis=2).all(axis=1)
        rest += places[~moves].tolist()
        if moves.any():
            out.append((places[moves], rings[moves, :-1]))
    return out, rest


def ring_vertices(polygons: DataFrame) -> DataFrame:
    """shape, x, y, px, py, qx, qy: the vertices of all rings, each with its neighbours, the smaller first; shape is a hash of the geometry."""

    def vertices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found = [], []
            geoms = batch.column(1).to_pylist()
            plain, rest = _plain(geoms)
            for k in rest:
                plain += [(np.array([k]), _open(r)[None]) for p in rings_of(geoms[k]) or [] for r in p]
            for places, rings in plain:
                before, behind = np.roll(rings, 1, axis=1), np.roll(rings, -1, axis=1)
                turned = (before[..., 0] > behind[..., 0]) | ((before[..., 0] == behind[..., 0]) & (before[..., 1] > behind[..., 1]))
                before[turned], behind[turned] = behind[turned], before[turned]
                owner.append(np.repeat(places, rings.shape[1]))
                found.append(np.concatenate([rings, before, behind], axis=2).reshape(-1, 6))
            if found:
                columns = np.ascontiguousarray(np.concatenate(found).T)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(owner))), *map(pa.array, columns)], names=["shape", "x", "y", *_NEAR])

    shapes = polygons.where("geom IS NOT NULL").select(F.xxhash64("geom").alias("shape"), "geom")
    return shapes.mapInArrow(vertices, "shape bigint, x double, y double, px double, py double, qx double, qy double")


def nodes(vertices: DataFrame) -> DataFrame:
    """shape, x, y: the nodes on the rings of each shape."""
    at, near = Window.partitionBy("x", "y"), F.struct(*_NEAR)
    met = vertices.withColumn("least", F.min(near).over(at)).withColumn("most", F.max(near).over(at))
    return met.where("least <> most").select("shape", "x", "y").distinct()


def _arcs(ring: np.ndarray, ends: set[tuple[float, float]]) -> list[np.ndarray]:
    """An open ring cut at its nodes, in order; a ring without any is one arc from its smallest vertex."""
    cuts = [k for k, v in enumerate(map(tuple, ring.tolist())) if v in ends]
    first = cuts[0] if cuts else int(np.lexsort((ring[:, 1], ring[:, 0]))[0])
    ring = np.concatenate([ring[first:], ring[: first + 1]])
    cuts = [k - first for k in cuts or [first]] + [len(ring) - 1]
    return [ring[a : b + 1] for a, b in zip(cuts, cuts[1:])]


def _simple_arc(arc: np.ndarray, tolerance: float) -> np.ndarray:
    """The arc's kept vertices, the same whichever way it runs."""
    turned = arc[::-1].tolist() < arc.tolist()
    arc = arc[::-1] if turned else arc
    arc = arc[kept_vertices(arc, tolerance)]
    return arc[::-1] if turned else arc


def simplified_of(geom: bytes | None, ends: set[tuple[float, float]], tolerance: float) -> tuple[bytes | None, list[tuple[float, float]]]:
    """The simplified polygon, and the vertices of rings that would vanish or turn over; null for what is no polygon."""
    shape, parts, flat = rings_of(geom), [], []
    for polygon in shape or []:
        rings = []
        for ring in polygon:
            bare = _open(ring)
            made = np.concatenate([_simple_arc(a, tolerance)[:-1] for a in _arcs(bare, ends)]) if len(bare) else ring
            made = np.concatenate([made, made[:1]])
            if len(made) <= len(bare) and (len(made) < 4 or ring_area(made) * ring_area(ring) <= 0):
                flat += map(tuple, bare.tolist())
            rings.append([tuple(v) for v in made.tolist()])
        parts.append(write_polygon(rings))
    return (write_many(MULTIPOLYGON, parts) if parts else None), flat


def _simple_arcs(rings: np.ndarray, cuts: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices of closed rings stay, when their arcs from cut to cut are simplified as by :func:`_simple_arc`."""
    keep = cuts.copy()
    row, a = np.nonzero(cuts[:, :-1])
    b = np.nonzero(cuts[:, 1:])[1] + 1
    for length in np.unique(b - a).tolist():
        if length > 1:
            some = np.flatnonzero(b - a == length)
            at = a[some, None] + np.arange(length + 1)
            arcs = rings[row[some, None], at]
            ahead, back = arcs.reshape(len(some), -1), arcs[:, ::-1].reshape(len(some), -1)
            first = np.arange(len(some)), (ahead != back).argmax(axis=1)
            turned = back[first] < ahead[first]
            arcs[turned] = arcs[turned][:, ::-1]
            stay = kept_alike(arcs, tolerance)
            stay[turned] = stay[turned][:, ::-1]
            keep[row[some, None], at] |= stay
    return keep


def simplified_all(geoms, xs, ys, tolerance: float) -> list[tuple[bytes | None, list[tuple[float, float]]]]:
    """:func:`simplified_of` of each geometry, with the nodes on each (null for none) as their coordinates; rings of as many vertices together."""
    geoms, xs, ys = list(geoms), list(xs), list(ys)
    out: list = [None] * len(geoms)
    plain, rest = _plain(geoms)
    for places, rings in plain:
        size = rings.shape[1]
        nodes_at = [np.empty((0, 2)) if xs[k] is None else np.stack([xs[k], ys[k]], axis=1) for k in places.tolist()]
        most = max(map(len, nodes_at))
        if size * most > 4096:  # not every vertex with every node
            rest += places.tolist()
            continue
        ends = np.full((len(places), most, 2), np.nan)
        for k, v in enumerate(nodes_at):
            ends[k, : len(v)] = v
        cuts = (rings[:, :, None] == ends[:, None]).all(axis=3).any(axis=2)
        lowest = np.where(rings[..., 0] == rings[..., 0].min(axis=1, keepdims=True), rings[..., 1], np.inf).argmin(axis=1)
        first = np.where(cuts.any(axis=1), cuts.argmax(axis=1), lowest)
        order = (first[:, None] + np.arange(size + 1)) % size
        rings, cuts = np.take_along_axis(rings, order[..., None], axis=1), np.take_along_axis(cuts, order, axis=1)
        cuts[:, [0, -1]] = True
        keep = _simple_arcs(rings, cuts, tolerance)
        counts = keep.sum(axis=1)
        # a vertex that goes is put onto the one before it, which leaves the area as it is
        shown = np.maximum.accumulate(np.where(keep, np.arange(size + 1), 0), axis=1)
        area = ring_areas(np.take_along_axis(rings, shown[..., None], axis=1))
        # rings that vanish or turn over, or nearly, are looked at one by one
        whole, box = ring_areas(rings), np.ptp(rings, axis=1).prod(axis=1)
        flat = (counts <= size) & ((counts < 4) | (area <= 1e-6 * box) | (whole <= 1e-6 * box))
        rest += places[flat].tolist()
        for place, made in zip(places[~flat].tolist(), polygons_of_rings(rings[~flat][keep[~flat]], counts[~flat])):
            out[place] = (made, [])
    for k in rest:
        out[k] = simplified_of(geoms[k], set() if xs[k] is None else set(zip(xs[k].tolist(), ys[k].tolist())), tolerance)
    return out


def simplified(polygons: DataFrame, tolerance: float) -> DataFrame:
    """The table with ``geom`` simplified: dropped vertices lie within ``tolerance`` of the border that is left, neighbours keep theirs in common.

    No ring is lost: where one would vanish or turn over, all its vertices become nodes, and all is simplified anew.
    Null geometries, what is no polygon and what is not finite give null; polygons that stand twice are simplified alike;
    other columns stay.
    """

    @F.pandas_udf("geom binary, x array<double>, y array<double>")
    def simple(geom: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        made = simplified_all(geom, xs, ys, tolerance)
        return pd.DataFrame({"geom": [g for g, _ in made], "x": [[v[0] for v in f] for _, f in made], "y": [[v[1] for v in f] for _, f in made]})

    vertices, other = ring_vertices(polygons), [F.col(f"`{c}`") for c in polygons.columns]
    ends = staged(nodes(vertices), "simplify-nodes")
    while True:
        # as many as the geometry has vertices at most
        own = ends.groupBy(F.col("shape").alias("_simple_shape")).agg(F.collect_list(F.struct("x", "y")).alias("_simple_at"))
        met = polygons.join(by_key(own), F.xxhash64("geom") == F.col("_simple_shape"), "left")
        out = staged(met.select(*other, simple("geom", "_simple_at.x", "_simple_at.y").alias("_simple")), "simplified")
        flat = out.where(F.size("_simple.x") > 0)
        if flat.isEmpty():
            return out.withColumn("geom", F.col("_simple.geom")).drop("_simple")
        pins = flat.select(F.explode(F.arrays_zip(F.col("_simple.x").alias("x"), F.col("_simple.y").alias("y"))).alias("v")).select("v.*").distinct()
        ends = staged(ends.union(vertices.select("shape", "x", "y").join(pins, ["x", "y"], "left_semi").select("shape", "x", "y")).distinct(), "simplify-nodes")
