"""Geometries as WKB in a binary column: encoding, bounds, centroids, container blobs, GeoJSON, Albers.

Geometries of any number of vertices go through Arrow batches; bytes that are no
geometry give null.
"""

from __future__ import annotations

import json
import math
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Codes of geometry types.
POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION = range(1, 8)
NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
SRID = 5070


class _Reader:
    """Reads one geometry; raises on bytes that are none."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, form: str):
        out = struct.unpack_from(form, self.data, self.at)
        self.at += struct.calcsize(form)
        return out

    def points(self, order: str, n: int) -> list[tuple[float, float]]:
        flat = self.take(f"{order}{2 * n}d")
        return list(zip(flat[::2], flat[1::2]))

    def geometry(self) -> tuple[int, list]:
        order = "<" if self.take("B")[0] else ">"
        kind = self.take(f"{order}I")[0] & 0xFFFF
        if kind == POINT:
            return kind, self.points(order, 1)
        count = self.take(f"{order}I")[0]
        if kind == LINE:
            return kind, self.points(order, count)
        if kind == POLYGON:
            return kind, [self.points(order, self.take(f"{order}I")[0]) for _ in range(count)]
        if kind in (MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION):
            return kind, [self.geometry() for _ in range(count)]
        raise ValueError(f"no geometry type {kind}")


def parse(data: bytes | None) -> tuple[int, list] | None:
    """Type and coordinates of a geometry, or null for bytes that are none. A container blob is unwrapped."""
    try:
        if data is None:
            return None
        if data[:2] == b"GP":
            data = data[8 + (0, 32, 48, 48, 64)[(data[3] >> 1) & 7] :]
        return _Reader(bytes(data)).geometry()
    except (struct.error, ValueError, IndexError, MemoryError, OverflowError):
        return None


def _outline(shape: tuple[int, list]) -> list[tuple[float, float]] | None:
    """The points that bound a geometry: all, but only the outer ring of a polygon; null if there are none or one is not finite.

    Empty parts of a geometry of many do not count.
    """
    kind, parts = shape
    if kind in (POINT, LINE):
        points = parts
    elif kind == POLYGON:
        points = parts[0] if parts else []
    else:
        inner = [_outline(p) for p in parts if p[1] and (p[0] != POLYGON or p[1][0])]
        if any(p is None for p in inner):
            return None
        points = [xy for p in inner for xy in p]
    return points if points and all(math.isfinite(v) for xy in points for v in xy) else None


def bounds_of(data: bytes | None) -> tuple[float, float, float, float] | None:
    """minx, miny, maxx, maxy."""
    shape = parse(data)
    points = _outline(shape) if shape else None
    if not points:
        return None
    xs, ys = zip(*points)
    return min(xs), min(ys), max(xs), max(ys)


_BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("minx", "miny", "maxx", "maxy")])


@F.pandas_udf(_BOX)
def bounds(geom: pd.Series) -> pd.DataFrame:
    rows = [bounds_of(g) or (None,) * 4 for g in geom]
    return pd.DataFrame(rows, columns=["minx", "miny", "maxx", "maxy"], dtype=float)


def centroid_of(data: bytes | None) -> tuple[float, float] | None:
    """Of polygons by area (holes count against), of lines by length, of points the mean."""
    shape = parse(data)
    if shape is None or _outline(shape) is None:
        return None
    area = length = ax = ay = lx = ly = 0.0
    points: list[tuple[float, float]] = []
    todo = [shape]
    while todo:
        kind, parts = todo.pop()
        if kind > POLYGON:
            todo += parts
            continue
        for k, ring in enumerate(parts if kind == POLYGON else [parts]):
            points += ring
            twice = cx = cy = 0.0
            for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
                side = math.hypot(x1 - x0, y1 - y0)
                length, lx, ly = length + side, lx + side * (x0 + x1) / 2, ly + side * (y0 + y1) / 2
                cross = x0 * y1 - x1 * y0
                twice, cx, cy = twice + cross, cx + (x0 + x1) * cross, cy + (y0 + y1) * cross
            if kind == POLYGON and twice:
                sign = (1 if twice > 0 else -1) * (-1 if k else 1)
                area, ax, ay = area + sign * twice / 2, ax + sign * cx / 6, ay + sign * cy / 6
    if area:
        return ax / area, ay / area
    if length:
        return lx / length, ly / length
    return sum(x for x, _ in points) / len(points), sum(y for _, y in points) / len(points)


@F.pandas_udf(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
def centroid(geom: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([centroid_of(g) or (None, None) for g in geom], columns=["x", "y"], dtype=float)


def write_line(points: np.ndarray) -> bytes:
    return struct.pack("<BII", 1, LINE, len(points)) + np.ascontiguousarray(points, "<f8").tobytes()


def _pieces(head: bytes, points: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Geometries with a head, a number of points and the points; ``counts`` of ``points`` for each."""
    data, ends = np.ascontiguousarray(points, "<f8").tobytes(), (16 * np.cumsum(counts)).tolist()
    heads = {n: head + struct.pack("<I", n) for n in set(counts.tolist())}
    return [heads[n] + data[e - 16 * n : e] for n, e in zip(counts.tolist(), ends)]


def _array(head: bytes, points: np.ndarray, counts: np.ndarray) -> pa.Array:
    """:func:`_pieces` as an Arrow array, without a value for each in Python."""
    front = len(head) + 4
    ends = np.cumsum(front + 16 * counts)
    size = int(ends[-1]) if len(ends) else 0
    if size >= 1 << 31:
        raise OverflowError("geometries of a batch take more than 2 GB")
    starts = np.concatenate([[0], ends]).astype(np.int32)
    heads = np.concatenate([np.broadcast_to(np.frombuffer(head, np.uint8), (len(counts), len(head))), counts.astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1)
    at = starts[:-1, None] + np.arange(front)
    body, data = np.ones(size, bool), np.empty(size, np.uint8)
    body[at], data[at] = False, heads
    data[body] = np.ascontiguousarray(points, "<f8").reshape(-1).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(starts), pa.py_buffer(data)])


def _binary(geoms) -> pa.Array:
    return geoms.cast(pa.binary()) if isinstance(geoms, pa.Array) else pa.array(list(geoms), pa.binary())


def _alike(geoms, head: bytes, least: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]:
    """Geometries of ``head``, a number of points, ``least`` or more, and the points: places and coordinates of those of as many points; and the places of all others.

    What is not finite is among the others. So a batch is worked on by few calls, with the same arithmetic for each geometry.
    """
    begin, rest, out = len(head), [], []
    array = _binary(geoms)
    _, offsets, data = array.buffers()
    starts = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].astype(int) if len(array) else np.zeros(1, int)
    data = np.frombuffer(data or b"", np.uint8)
    lengths = np.where(array.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), 0)
    order = np.argsort(lengths, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
        size = int(lengths[places[0]])
        count, odd = divmod(size - begin - 4, 16)
        if count < least or odd:
            rest += places.tolist()
            continue
        # places of bytes take eight times what the bytes take
        found = data[starts[places, None] + np.arange(size)] if size <= 1024 else np.stack([data[s : s + size] for s in starts[places].tolist()])
        xy = np.ascontiguousarray(found[:, begin + 4 :]).view("<f8").reshape(len(places), -1, 2)
        usual = (found[:, : begin + 4] == np.frombuffer(head + struct.pack("<I", count), np.uint8)).all(axis=1) & np.isfinite(xy).all(axis=(1, 2))
        rest += places[~usual].tolist()
        if usual.any():
            out.append((places[usual], xy[usual]))
    return out, rest


_LINE_HEAD = struct.pack("<BI", 1, LINE)
_RING_HEAD = struct.pack("<BII", 1, POLYGON, 1)


def _along(xy: np.ndarray) -> np.ndarray:
    """The length up to each vertex of lines of as many vertices."""
    sides = np.hypot(*np.moveaxis(np.diff(xy, axis=1), 2, 0))
    return np.concatenate([np.zeros((len(xy), 1)), np.cumsum(sides, axis=1)], axis=1)


def write_many(kind: int, parts: list[bytes]) -> bytes:
    """One geometry of many parts, or the only part itself."""
    return parts[0] if len(parts) == 1 else struct.pack("<BII", 1, kind, len(parts)) + b"".join(parts)


def _measured(data: bytes | None) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Vertices of each line and the length up to each, running on from line to line; null for what is no line, or not finite."""
    if data is not None and data[:5] == b"\x01\x02\0\0\0" and len(data) > 24:  # the usual layout needs no reader
        count = int.from_bytes(data[5:9], "little")
        found = [np.frombuffer(data, "<f8", 2 * count, 9).reshape(-1, 2)] if len(data) >= 9 + 16 * count else None
    else:
        shape = parse(data)
        found = [shape[1]] if shape and shape[0] == LINE else [p[1] for p in shape[1]] if shape and shape[0] == MULTILINE else None
    out, before = [], 0.0
    for points in found or []:
        if len(points):
            xy = np.asarray(points)
            sides = np.hypot(*np.diff(xy, axis=0).T) if len(xy) > 1 else np.empty(0)
            out.append((xy, before + np.concatenate([[0.0], np.cumsum(sides)])))
            before = out[-1][1][-1]
    return out if out and np.isfinite(before) and all(np.isfinite(xy).all() for xy, _ in out) else None


def cut_line_of(data: bytes | None, parts: int) -> list[bytes | None]:
    """``parts`` lines of equal length that follow one another: vertices between two cuts, and interpolated points at the cuts.

    Lengths run on over the lines of a multi-line, so a part that holds a gap is a multi-line. A line without
    length is a part of its own, and the other parts are null; so are all parts of what is no line.
    """
    lines = _measured(data)
    if lines is None:
        return [None] * parts
    total = float(lines[-1][1][-1])
    if parts == 1 or not total:
        return [data] + [None] * (parts - 1)
    cuts = total * np.arange(parts + 1) / parts
    pieces: list[list[bytes]] = [[] for _ in range(parts)]
    for xy, at in lines:
        begin, end = at[0], at[-1]
        first, last = max(0, int(np.searchsorted(cuts, begin, "right")) - 1), min(parts, int(np.searchsorted(cuts, end, "left")))
        bounds = np.clip(cuts[first : last + 1], begin, end)
        ends = np.stack([np.interp(bounds, at, xy[:, k]) for k in (0, 1)], axis=1)
        ends[bounds == begin], ends[bounds == end] = xy[0], xy[-1]
        for k in range(len(bounds) - 1):
            inner = xy[np.searchsorted(at, bounds[k], "right") : np.searchsorted(at, bounds[k + 1], "left")]
            pieces[first + k].append(write_line(np.concatenate([ends[k : k + 1], inner, ends[k + 1 : k + 2]])))
    return [write_many(MULTILINE, p) if p else None for p in pieces]


def _cut_alike(xy: np.ndarray, at: np.ndarray, parts: int) -> list[bytes]:
    """What :func:`cut_line_of` makes of lines of as many vertices, all in as many parts, one line's parts after another's."""
    rows, points = xy.shape[:2]
    total = at[:, -1:]
    bounds = np.minimum(total * np.arange(parts + 1) / parts, total)
    right = (at[:, None] <= bounds[:, :, None]).sum(axis=2)
    left = (at[:, None] < bounds[:, :, None]).sum(axis=2)
    j = np.minimum(right - 1, points - 2)
    row = np.arange(rows)[:, None]
    a, b = at[row, j], at[row, j + 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        ends = (xy[row, j + 1] - xy[row, j]) / (b - a)[:, :, None] * (bounds - a)[:, :, None] + xy[row, j]
    ends[:, 0] = xy[:, 0]
    ends = np.where((bounds == total)[:, :, None], xy[:, -1:], ends)
    inner = np.maximum(left[:, 1:] - right[:, :-1], 0).ravel()
    counts = inner + 2
    begin = np.cumsum(counts) - counts
    place = np.arange(counts.sum()) - np.repeat(begin, counts)
    base = rows * (parts + 1)
    vertex = base + (row * points + right[:, :-1]).ravel()
    take = np.repeat(vertex, counts) + place - 1
    cut = (row * (parts + 1) + np.arange(parts)).ravel()
    take[begin], take[begin + counts - 1] = cut, cut + 1
    return _pieces(_LINE_HEAD, np.concatenate([ends.reshape(-1, 2), xy.reshape(-1, 2)])[take], counts)


def cut_lines_of(geoms, parts) -> list[list[bytes | None]]:
    """:func:`cut_line_of` of each line."""
    geoms, parts = _binary(geoms), np.asarray(parts, int)
    out: list = [None] * len(geoms)
    alike, rest = _alike(geoms, _LINE_HEAD, 2)
    for places, xy in alike:
        at = _along(xy)
        # others have no length, or so little that cuts fall together
        usual = np.isfinite(at[:, -1]) & (at[:, -1] / np.maximum(parts[places], 1) > 1e-300) & (parts[places] > 1)
        rest += places[~usual].tolist()
        for n in np.unique(parts[places[usual]]).tolist():
            same = usual & (parts[places] == n)
            # bounded by vertices and cuts looked at together
            for some in np.array_split(np.flatnonzero(same), 1 + same.sum() * (n + 1) * xy.shape[1] // 5_000_000):
                made = _cut_alike(xy[some], at[some], n) if len(some) else []
                for k, place in enumerate(places[some].tolist()):
                    out[place] = made[k * n : (k + 1) * n]
    for k in rest:
        out[k] = cut_line_of(geoms[k].as_py(), int(parts[k]))
    return out


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def cut_line(geom: pa.Array, parts: pa.Array) -> pa.Array:
    return pa.array(cut_lines_of(geom, parts.to_numpy(zero_copy_only=False)), pa.list_(pa.binary()))


@F.arrow_udf(T.StructType([*(T.StructField(c, T.DoubleType()) for c in ("x0", "y0", "x1", "y1", "length")), T.StructField("points", T.LongType())]))
def line_summary(geom: pa.Array) -> pa.Array:
    """Both ends, length and vertices of a line; null for what is none."""

    def of(g: bytes | None):
        lines = _measured(g)
        return (*lines[0][0][0], *lines[-1][0][-1], lines[-1][1][-1], sum(len(xy) for xy, _ in lines)) if lines else (np.nan,) * 6

    found = np.full((len(geom), 6), np.nan)
    alike, rest = _alike(geom, _LINE_HEAD, 1)
    for places, xy in alike:
        length = _along(xy)[:, -1:]
        row = np.concatenate([xy[:, 0], xy[:, -1], length, np.full((len(xy), 1), float(xy.shape[1]))], axis=1)
        found[places] = np.where(np.isfinite(length), row, np.nan)
    for k in rest:
        found[k] = of(geom[k].as_py())
    *columns, points = [pa.array(v, from_pandas=True) for v in found.T]
    return pa.StructArray.from_arrays([*columns, points.cast(pa.int64())], names=["x0", "y0", "x1", "y1", "length", "points"])


def ring_area(ring: np.ndarray) -> float:
    """Of a closed ring, positive if it runs counterclockwise; taken from its first vertex, so that far coordinates lose nothing."""
    x, y = (ring - ring[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def rings_of(data: bytes | None) -> list[list[np.ndarray]] | None:
    """The rings of each polygon, closed, outer ones counterclockwise and holes clockwise; null for what is no polygon, or not finite."""
    shape = parse(data)
    if shape is None or shape[0] not in (POLYGON, MULTIPOLYGON):
        return None
    out = []
    for polygon in [shape[1]] if shape[0] == POLYGON else [p[1] for p in shape[1]]:
        rings = [np.array(r) + 0.0 for r in polygon if len(r) > 2]
        rings = [r if (r[0] == r[-1]).all() else np.concatenate([r, r[:1]]) for r in rings]
        if not all(np.isfinite(r).all() for r in rings):
            return None
        out.append([r if (ring_area(r) > 0) == (k == 0) else r[::-1] for k, r in enumerate(rings)])
    return out


def ring_areas(rings: np.ndarray) -> np.ndarray:
    """:func:`ring_area` of closed rings of as many vertices."""
    x, y = np.moveaxis(rings - rings[:, :1], 2, 0)
    return (x[:, :-1] * y[:, 1:] - x[:, 1:] * y[:, :-1]).sum(axis=1) / 2


def plain_polygons(geoms) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]:
    """Polygons of one closed ring, as :func:`rings_of` has them: places and rings of those of as many vertices; and the places of all others."""
    alike, rest = _alike(geoms, _RING_HEAD, 4)
    out = []
    for places, rings in alike:
        rings = rings + 0.0
        closed = (rings[:, 0] == rings[:, -1]).all(axis=1)
        rest += places[~closed].tolist()
        places, rings = places[closed], rings[closed]
        if len(places):
            right = ring_areas(rings) <= 0
            rings[right] = rings[right][:, ::-1]
            out.append((places, rings))
    return out, rest


@F.pandas_udf(T.StructType([T.StructField("area", T.DoubleType()), *(T.StructField(c, T.LongType()) for c in ("outers", "holes", "points"))]))
def polygon_summary(geom: pd.Series) -> pd.DataFrame:
    """Area without holes, rings of both kinds, and sides of all rings; null for what is no polygon."""

    def of(g: bytes | None):
        shape = rings_of(g)
        if shape is None:
            return (np.nan,) * 4
        return sum(ring_area(r) for p in shape for r in p), sum(bool(p) for p in shape), sum(len(p[1:]) for p in shape), sum(len(r) - 1 for p in shape for r in p)

    found = np.full((len(geom), 4), np.nan)
    geoms = list(geom)
    plain, rest = plain_polygons(geoms)
    for places, rings in plain:
        found[places] = np.stack([ring_areas(rings), *(np.full(len(places), float(v)) for v in (1, 0, rings.shape[1] - 1))], axis=1)
    for k in rest:
        found[k] = of(geoms[k])
    frame = pd.DataFrame(found, columns=["area", "outers", "holes", "points"])
    return frame.astype({c: "Int64" for c in ("outers", "holes", "points")})


def kept_vertices(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices of a line stay, its ends among them; the others lie within ``tolerance`` of the line through those."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        (ux, uy), (x, y) = points[b] - points[a], (points[a + 1 : b] - points[a]).T
        square = ux * ux + uy * uy
        share = np.clip((x * ux + y * uy) / square, 0, 1) if square else np.zeros(len(x))
        away = np.hypot(x - share * ux, y - share * uy)
        far = int(away.argmax())
        if away[far] > tolerance:
            keep[a + 1 + far] = True
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep


def kept_alike(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """:func:`kept_vertices` of lines of as many vertices, with the same arithmetic, so that it is the same."""
    rows, points = xy.shape[:2]
    if points > 64:  # not all vertices for each stretch
        return np.array([kept_vertices(p, tolerance) for p in xy])
    keep = np.zeros((rows, points), bool)
    keep[:, [0, -1]] = True
    line, a, b = np.arange(rows), np.zeros(rows, int), np.full(rows, points - 1)
    vertex = np.arange(points)
    while True:
        long = b - a > 1
        line, a, b = line[long], a[long], b[long]
        if not len(line):
            return keep
        (ux, uy), (x, y) = (xy[line, b] - xy[line, a]).T[:, :, None], np.moveaxis(xy[line] - xy[line, a][:, None], 2, 0)
        square = ux * ux + uy * uy
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(square != 0, np.clip((x * ux + y * uy) / square, 0, 1), 0.0)
        away = np.hypot(x - share * ux, y - share * uy)
        away = np.where((vertex > a[:, None]) & (vertex < b[:, None]), away, -1.0)
        far = away.argmax(axis=1)
        on = away[np.arange(len(line)), far] > tolerance
        line, a, b, far = line[on], a[on], b[on], far[on]
        keep[line, far] = True
        line, a, b = np.concatenate([line, line]), np.concatenate([a, far]), np.concatenate([far, b])


def simple_line_of(data: bytes | None, tolerance: float) -> bytes | None:
    """A line, or each line of several, without vertices within ``tolerance``; ends stay. Null for what is no line, or not finite."""
    shape = parse(data)
    if shape is None or shape[0] not in (LINE, MULTILINE):
        return None
    lines = [np.array(p) for p in ([shape[1]] if shape[0] == LINE else [q for _, q in shape[1]]) if p]
    if not lines or not all(np.isfinite(p).all() for p in lines):
        return None
    return write_many(MULTILINE, [write_line(p[kept_vertices(p, tolerance)]) for p in lines])


def simple_line(geom: Column, tolerance: float) -> Column:
    @F.arrow_udf(T.BinaryType())
    def convert(geoms: pa.Array) -> pa.Array:
        alike, rest = _alike(geoms, _LINE_HEAD, 1)
        kept = [(xy, kept_alike(xy, tolerance)) for _, xy in alike]
        made = [_array(_LINE_HEAD, xy[keep], keep.sum(axis=1)) for xy, keep in kept]
        made.append(pa.array([simple_line_of(geoms[k].as_py(), tolerance) for k in rest], pa.binary()))
        places = np.concatenate([*(at for at, _ in alike), np.array(rest, int)])
        return pa.concat_arrays(made).take(pa.array(np.argsort(places)))

    return convert(geom)


def write_polygon(rings: list[list[tuple[float, float]]]) -> bytes:
    out = struct.pack("<BII", 1, POLYGON, len(rings))
    for ring in rings:
        out += struct.pack(f"<I{2 * len(ring)}d", len(ring), *(v for xy in ring for v in xy))
    return out


def polygons_of_rings(points: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A polygon of one closed ring for each of ``counts``, that many of ``points`` each."""
    return _pieces(_RING_HEAD, points, counts)


def _records(layout: list[tuple], columns: dict, missing: np.ndarray) -> pd.Series:
    """Geometries of one fixed layout, all packed at once; null where a value is missing."""
    table = np.zeros(len(missing), np.dtype([("order", "u1"), ("kind", "<u4"), *layout]))
    for name, values in ({"order": 1} | columns).items():
        table[name] = values
    data, size = table.tobytes(), table.dtype.itemsize
    return pd.Series([None if none else data[k * size : (k + 1) * size] for k, none in enumerate(missing)], dtype=object)


@F.pandas_udf(T.BinaryType())
def point(x: pd.Series, y: pd.Series) -> pd.Series:
    xy = np.stack([x.to_numpy(float), y.to_numpy(float)], axis=1)
    return _records([("xy", "<f8", (2,))], {"kind": POINT, "xy": xy}, np.isnan(xy).any(axis=1))


@F.arrow_udf(T.BinaryType())
def line(xs: pa.Array, ys: pa.Array) -> pa.Array:
    """A line through the points; null for null, a missing x or y is not finite."""
    counts = xs.value_lengths()
    points = np.stack([v.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) for v in (xs, ys)], axis=1)
    made = _array(_LINE_HEAD, points, counts.fill_null(0).to_numpy())
    return pc.if_else(xs.is_valid(), made, None) if xs.null_count else made


@F.pandas_udf(T.BinaryType())
def polygon(xs: pd.Series, ys: pd.Series) -> pd.Series:
    """A polygon of one ring, closed if it is not."""
    rings = [np.array([a, b], float).T for a, b in zip(xs, ys)]
    rings = [r if (r[0] == r[-1]).all() else np.concatenate([r, r[:1]]) for r in rings]
    return pd.Series(_pieces(_RING_HEAD, np.concatenate([np.empty((0, 2)), *rings]), np.array([len(r) for r in rings], int)), dtype=object)


@F.pandas_udf(T.BinaryType())
def rectangle(x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    a, b, c, d = (v.to_numpy(float) for v in (x0, y0, x1, y1))
    corners = np.stack([a, b, c, b, c, d, a, d, a, b], axis=1)
    return _records([("rings", "<u4"), ("points", "<u4"), ("xy", "<f8", (10,))], {"kind": POLYGON, "rings": 1, "points": 5, "xy": corners}, np.zeros(len(a), bool))


@F.pandas_udf(T.BinaryType())
def to_blob(geom: pd.Series) -> pd.Series:
    """A container blob: header, envelope (minx, maxx, miny, maxy) where there are bounds, WKB. Blobs stay as they are."""

    def wrap(g: bytes | None) -> bytes | None:
        if g is None or g[:2] == b"GP":
            return g
        box = bounds_of(g)
        head = struct.pack("<2sBBi", b"GP", 0, 3 if box else 1, SRID)
        return head + (struct.pack("<4d", box[0], box[2], box[1], box[3]) if box else b"") + g

    return pd.Series([wrap(g) for g in geom])


def from_blob(blob: Column) -> Column:
    """The WKB of a container blob; other bytes stay as they are."""
    flags = F.conv(F.hex(F.substring(blob, 4, 1)), 16, 10).cast("int")
    envelope = F.element_at(F.array(*map(F.lit, (0, 32, 48, 48, 64, 0, 0, 0))), F.shiftright(flags, 1).bitwiseAND(F.lit(7)) + 1)
    inner = F.substring(blob, F.lit(9) + envelope, F.length(blob))
    return F.when(F.hex(F.substring(blob, 1, 2)) == "4750", inner).otherwise(blob)


#: The ellipsoid, origin and parallels of EPSG:5070.
_A, _FLAT = 6378137.0, 1 / 298.257222101
_PHI0, _LAM0, _PHI1, _PHI2 = (math.radians(v) for v in (23.0, -96.0, 29.5, 45.5))
_E2 = 2 * _FLAT - _FLAT**2
_E = math.sqrt(_E2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - _E2 * math.sin(phi) ** 2)


_N = (_m(_PHI1) ** 2 - _m(_PHI2) ** 2) / (_q(_PHI2) - _q(_PHI1))
_C = _m(_PHI1) ** 2 + _N * _q(_PHI1)
_RHO0 = _A * math.sqrt(_C - _N * _q(_PHI0)) / _N
NEWTON_STEPS = 10


def albers_inverse(x: Column, y: Column) -> Column:
    """struct(lon, lat) in degrees of EPSG:5070 metres; the latitude takes ten Newton steps from asin(q / 2)."""
    north = F.lit(_RHO0) - y
    rho, theta = F.sqrt(x * x + north * north), F.atan2(x, north)
    q = (F.lit(_C) - (rho * (_N / _A)) * (rho * (_N / _A))) / _N

    def newton(phi: Column, _: Column) -> Column:
        s = F.sin(phi)
        t = 1 - s * s * _E2
        inner = q / (1 - _E2) - s / t + F.log((1 - s * _E) / (1 + s * _E)) / (2 * _E)
        return phi + t * t / (2 * F.cos(phi)) * inner

    phi = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), F.asin(q / 2), newton)
    return F.struct((F.degrees(theta / _N) + math.degrees(_LAM0)).alias("lon"), F.degrees(phi).alias("lat"))


def lon_lat(x: float, y: float) -> tuple[float, float]:
    """The same for one point, where a geometry's vertices are at hand in a batch."""
    north = _RHO0 - y
    rho, theta = math.hypot(x, north), math.atan2(x, north)
    q = (_C - (rho * _N / _A) ** 2) / _N
    phi = math.asin(q / 2)
    for _ in range(NEWTON_STEPS):
        s = math.sin(phi)
        t = 1 - _E2 * s * s
        phi += t * t / (2 * math.cos(phi)) * (q / (1 - _E2) - s / t + math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    return math.degrees(theta / _N + _LAM0), math.degrees(phi)


def _coordinates(shape: tuple[int, list], place) -> list:
    kind, parts = shape
    if kind == POINT:
        return list(place(*parts[0]))
    if kind == LINE:
        return [list(place(*xy)) for xy in parts]
    if kind == POLYGON:
        return [[list(place(*xy)) for xy in ring] for ring in parts]
    return [_coordinates(p, place) for p in parts]


def geojson_of(data: bytes | None, project: bool) -> tuple | None:
    """GeoJSON text, and the box of the first part's points; null where the geometry is none, a multi-point or a collection."""
    shape = parse(data)
    if shape is None or shape[0] in (MULTIPOINT, COLLECTION):
        return None
    try:
        coordinates = _coordinates(shape, lon_lat if project else lambda x, y: (x, y))
    except ValueError:
        return None
    first = coordinates
    while first and isinstance(first[0], list) and first[0] and isinstance(first[0][0], list):
        first = first[0]
    points = [first] if shape[0] == POINT else first
    points = [p for p in points if all(map(math.isfinite, p))]
    xs, ys = zip(*points) if points else ((), ())
    box = (min(xs), min(ys), max(xs), max(ys)) if points else (None,) * 4
    return json.dumps({"type": NAMES[shape[0]], "coordinates": coordinates}, separators=(",", ":")), *box


def geojson(geom: Column, project: bool = True) -> Column:
    """struct(json, minx, miny, maxx, maxy)."""

    @F.pandas_udf(T.StructType([T.StructField("json", T.StringType()), *_BOX]))
    def convert(series: pd.Series) -> pd.DataFrame:
        rows = [geojson_of(g, project) or (None,) * 5 for g in series]
        return pd.DataFrame(rows, columns=["json", "minx", "miny", "maxx", "maxy"])

    return convert(geom)
