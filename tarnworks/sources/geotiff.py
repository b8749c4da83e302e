"""GeoTIFF grids: cells read by strips and tiles of many files, windows without the parts outside, blocks of cells written by tasks.

Only a file's head is read where the plan is made; a task reads the bytes of its own strips or tiles. Paths may be of any
file system that Arrow opens (local, HDFS, S3, GCS). The first image of a file counts, as further ones are overviews or masks.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tarnworks.sources.files import opened

# fixed values of the format: struct codes of field types, and tags by name
_FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
_TAGS = {
    256: "width", 257: "height", 258: "bits", 259: "compression", 273: "offsets", 277: "samples", 278: "rows", 279: "counts", 284: "planar", 317: "predictor",
    322: "tile_width", 323: "tile_height", 324: "offsets", 325: "counts", 339: "format", 33550: "scale", 33922: "tie", 34264: "matrix", 42113: "nodata",
}
_NONE, _LZW, _DEFLATE, _OLD_DEFLATE, _PACKBITS, _ZSTD = 1, 5, 8, 32946, 32773, 50000

CELLS = T.StructType().add("path", T.StringType()).add("band", T.IntegerType()).add("col", T.LongType()).add("row", T.LongType()).add("value", T.DoubleType())


def files_of(path: str) -> list[str]:
    """The file itself, or the ``.tif`` and ``.tiff`` files of a folder by name."""
    system, inner = opened(path)
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return [path]
    names = sorted(i.base_name for i in system.get_file_info(fs.FileSelector(inner)) if i.base_name.lower().endswith((".tif", ".tiff")))
    return [f"{path.rstrip('/')}/{n}" for n in names]


@dataclass
class Grid:
    """The head of a file. ``x``, ``y``: its south-west corner; cells are ``dx`` by ``dy``."""

    path: str
    width: int
    height: int
    dtype: np.dtype
    bands: int
    planar: bool
    compression: int
    predictor: int
    part: tuple[int, int]  # columns and rows of a strip or tile
    tiled: bool
    offsets: tuple = field(repr=False)
    counts: tuple = field(repr=False)
    nodata: float | None
    x: float
    y: float
    dx: float
    dy: float

    @property
    def across(self) -> int:
        return -(-self.width // self.part[0])

    @property
    def down(self) -> int:
        return -(-self.height // self.part[1])

    def shift(self, origin: tuple[float, float] | None) -> tuple[int, int]:
        return (0, 0) if origin is None else (round((self.x - origin[0]) / self.dx), round((self.y - origin[1]) / self.dy))


def head(path: str) -> Grid:
    """The head of a file, classic or big, of either byte order."""
    system, inner = opened(path)
    with system.open_input_file(inner) as file:

        def at(offset: int, form: str) -> tuple:
            return struct.unpack(form, file.read_at(struct.calcsize(form), offset))

        order = {b"II": "<", b"MM": ">"}.get(bytes(file.read_at(2, 0)))
        version = at(2, f"{order}H")[0] if order else None
        if version not in (42, 43):
            raise ValueError(f"{path} is no TIFF")
        number, entry, word = ("H", 12, "I") if version == 42 else ("Q", 20, "Q")
        start = at(4 if version == 42 else 8, order + word)[0]
        size, found = struct.calcsize(order + number), {}
        entries = at(start, order + number)[0]
        for k in range(entries):
            where = start + size + k * entry
            tag, kind, count = at(where, f"{order}HH{word}")
            if tag not in _TAGS or kind not in _FIELDS:
                continue
            form = f"{order}{count}s" if kind == 2 else order + _FIELDS[kind] * count if len(_FIELDS[kind]) > 1 else f"{order}{count}{_FIELDS[kind]}"
            value_at = where + 4 + struct.calcsize(order + word)
            inline = struct.calcsize(form) <= struct.calcsize(order + word)
            found[_TAGS[tag]] = at(value_at if inline else at(value_at, order + word)[0], form)
    one = lambda name, default=None: found[name][0] if name in found else default
    bits, samples = set(found.get("bits", (1,))), one("samples", 1)
    kind = {1: "u", 2: "i", 3: "f"}.get(one("format", 1))
    if len(bits) != 1 or not bits <= {8, 16, 32, 64} or kind is None:
        raise ValueError(f"{path}: {sorted(bits)} bits a sample, format {one('format', 1)}, are not read")
    tiled = "tile_width" in found
    part = (one("tile_width"), one("tile_height")) if tiled else (one("width"), min(one("rows", one("height")), one("height")))
    dx, dy = found["scale"][:2] if "scale" in found else (found["matrix"][0], -found["matrix"][5]) if "matrix" in found else (1.0, 1.0)
    if "tie" in found:
        i, j, _, x, top = found["tie"][:5]
        x, top = x - i * dx, top + j * dy
    else:
        x, top = (found["matrix"][3], found["matrix"][7]) if "matrix" in found else (0.0, one("height") * dy)
    text = found["nodata"][0].split(b"\0")[0].strip().decode() if "nodata" in found else ""
    return Grid(
        path, one("width"), one("height"), np.dtype(f"{order}{kind}{bits.pop() // 8}"), samples, one("planar", 1) == 2 and samples > 1, one("compression", 1), one("predictor", 1),
        part, tiled, found["offsets"], found["counts"], float(text) if text else None, x, top - one("height") * dy, dx, dy,
    )


def _unpacked(data: bytes, size: int) -> bytes:
    out, k = bytearray(), 0
    while k < len(data) and len(out) < size:
        run = data[k]
        if run < 128:
            out += data[k + 1 : k + 2 + run]
            k += 2 + run
        else:
            out += data[k + 1 : k + 2] * (257 - run if run > 128 else 0)
            k += 2 if run > 128 else 1
    return bytes(out)


def _lzw(data: bytes, size: int) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first; 256 empties the table, 257 ends."""
    out, table, last = bytearray(), None, b""
    held = bits = at = 0
    width = 9
    while len(out) < size:
        while bits < width and at < len(data):
            held, bits, at = (held << 8 | data[at]) & 0xFFFFFF, bits + 8, at + 1
        if bits < width:
            break
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256 or table is None:
            table, width, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            if code == 256:
                continue
        word = table[code] if code < len(table) else last + last[:1]
        if last and len(table) < 4096:
            table.append(last + word[:1])
        out += word
        last = word
        # a code grows one entry before it must
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return bytes(out)


def _decoded(grid: Grid, data: bytes, size: int) -> bytes:
    if grid.compression == _NONE:
        return data
    if grid.compression in (_DEFLATE, _OLD_DEFLATE):
        return zlib.decompress(data)
    if grid.compression == _LZW:
        return _lzw(data, size)
    if grid.compression == _PACKBITS:
        return _unpacked(data, size)
    if grid.compression == _ZSTD:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
    raise ValueError(f"{grid.path}: compression {grid.compression} is not read")


def block(grid: Grid, data: bytes, rows: int) -> np.ndarray:
    """The samples of a strip or tile as rows by columns by samples; a strip may end early at ``rows``."""
    wide, deep = grid.part[0], 1 if grid.planar else grid.bands
    raw = np.frombuffer(_decoded(grid, data, rows * wide * deep * grid.dtype.itemsize), np.uint8)[: rows * wide * deep * grid.dtype.itemsize]
    if grid.predictor == 3:
        # bytes of one place of all numbers of a row stand together, the highest first, each as a difference
        planes = np.add.accumulate(raw.reshape(rows, -1, deep), axis=1, dtype=np.uint8).reshape(rows, grid.dtype.itemsize, wide * deep)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(grid.dtype.newbyteorder(">")).reshape(rows, wide, deep)
    values = raw.view(grid.dtype).reshape(rows, wide, deep)
    if grid.predictor == 2:
        return np.add.accumulate(values, axis=1, dtype=grid.dtype.newbyteorder("="))
    return values


@dataclass
class _Parts(InputPartition):
    grid: Grid  # without offsets and counts
    parts: list[tuple[int, int, int]]  # place, offset, bytes


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.cells = int(options.get("cells", 4 << 20))
        self.origin = tuple(map(float, options["origin"].split(","))) if "origin" in options else None
        self.least, self.most = {}, {}

    def shown(self, grid: Grid, place: int) -> tuple[list[int], int, int, int, int]:
        """The bands of a part, its first and last column and its first and last row, counted from the south."""
        band, inner = divmod(place, grid.across * grid.down)
        down, across = divmod(inner, grid.across)
        shift_x, shift_y = grid.shift(self.origin)
        left, top = across * grid.part[0], down * grid.part[1]
        right, bottom = min(left + grid.part[0], grid.width) - 1, min(top + grid.part[1], grid.height) - 1
        bands = [band + 1] if grid.planar else list(range(1, grid.bands + 1))
        return bands, left + shift_x, right + shift_x, grid.height - 1 - bottom + shift_y, grid.height - 1 - top + shift_y

    def wanted(self, grid: Grid, place: int) -> bool:
        bands, *box = self.shown(grid, place)
        spans = {"col": box[:2], "row": box[2:], "band": [bands[0], bands[-1]]}
        return all(high >= self.least.get(k, high) and low <= self.most.get(k, low) for k, (low, high) in spans.items())

    def partitions(self) -> list[_Parts]:
        """Neighbouring strips or tiles of one file, about ``cells`` cells a task."""
        out = []
        for path in files_of(self.path):
            grid = head(path)
            offsets, counts, grid.offsets, grid.counts = grid.offsets, grid.counts, (), ()
            parts = [(k, at, n) for k, (at, n) in enumerate(zip(offsets, counts)) if self.wanted(grid, k)]
            each = max(1, self.cells // (grid.part[0] * grid.part[1] * (1 if grid.planar else grid.bands)))
            out += [_Parts(grid, parts[k : k + each]) for k in range(0, len(parts), each)]
        return out or [_Parts(None, [])]

    def read(self, partition: _Parts):
        grid = partition.grid
        if grid is None:
            return
        schema = pa.schema([(f.name, {"path": pa.string(), "band": pa.int32(), "value": pa.float64()}.get(f.name, pa.int64())) for f in self.schema])
        system, inner = opened(grid.path)
        with system.open_input_file(inner) as file:
            for place, offset, size in partition.parts:
                bands, left, right, bottom, top = self.shown(grid, place)
                wide, high = right - left + 1, top - bottom + 1
                # parts without bytes were never written: no data
                values = block(grid, file.read_at(size, offset), grid.part[1] if grid.tiled else high)[:high, :wide] if size else None
                for k, band in enumerate(bands):
                    numbers = np.full(wide * high, np.nan) if values is None else values[:, :, k].astype(np.float64).ravel()
                    missing = np.isnan(numbers) | (numbers == _as_stored(grid) if grid.nodata is not None else False)
                    made = {
                        "path": lambda: pa.array([grid.path]).take(pa.array(np.zeros(wide * high, np.int8))),
                        "band": lambda band=band: pa.array(np.full(wide * high, band, np.int32)),
                        "col": lambda: pa.array(np.tile(np.arange(left, right + 1), high)),
                        "row": lambda: pa.array(np.repeat(np.arange(top, bottom - 1, -1), wide)),
                        "value": lambda numbers=numbers, missing=missing: pa.array(numbers, mask=missing),
                    }
                    yield pa.RecordBatch.from_arrays([made[f.name]() for f in self.schema], schema=schema)


def _as_stored(grid: Grid) -> float:
    """The no-data value as the samples' type holds it."""
    return float(np.float32(grid.nodata)) if grid.dtype.kind == "f" and grid.dtype.itemsize == 4 else grid.nodata


class _FilteringReader(_Reader):
    def pushFilters(self, filters):
        """Limits of col, row and band leave out strips and tiles; Spark still tests each cell."""
        for rule in filters:
            name, value = (rule.attribute[0], rule.value) if isinstance(rule, (D.EqualTo, D.GreaterThan, D.GreaterThanOrEqual, D.LessThan, D.LessThanOrEqual)) else (None, None)
            if name in ("col", "row", "band") and value is not None:
                if not isinstance(rule, (D.LessThan, D.LessThanOrEqual)):
                    self.least[name] = max(self.least.get(name, value), value)
                if not isinstance(rule, (D.GreaterThan, D.GreaterThanOrEqual)):
                    self.most[name] = min(self.most.get(name, value), value)
            yield rule


class GeoTiff(DataSource):
    """Options: cells (about this many a task), origin ("x,y": columns and rows count from there), filters ("true": see :func:`read_geotiff`)."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> T.StructType:
        return CELLS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return (_FilteringReader if self.options.get("filters") == "true" else _Reader)(self.options, schema)


def read_geotiff(spark: SparkSession, path: str, columns: list[str] | None = None, origin: tuple[float, float] | None = None, cells: int = 4 << 20) -> DataFrame:
    """path, band, col, row, value of a file or of all files of a folder; no-data and NaN are null.

    Rows count from the south, as in ASCII grids, from each file's corner or from a common ``origin`` (x, y). Filters on
    col, row and band skip the strips or tiles outside. Compression: none, deflate, LZW, PackBits and Zstandard.
    """
    spark.dataSource.register(GeoTiff)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("geotiff").schema(T.StructType([CELLS[c] for c in columns or CELLS.names])).options(cells=cells, filters="true")
    return (reader.option("origin", f"{origin[0]!r},{origin[1]!r}") if origin else reader).load(path)


def encoded(values: np.ndarray, x: float, y: float, size: float, nodata: float) -> bytes:
    """A grid (rows from the north) of doubles as a file of one deflated strip; ``x``, ``y``: its south-west corner."""
    rows, columns = values.shape
    data = zlib.compress(np.ascontiguousarray(values, "<f8").tobytes())
    blobs = {33550: struct.pack("<3d", size, size, 0), 33922: struct.pack("<6d", 0, 0, 0, x, y + rows * size, 0), 42113: repr(nodata).encode() + b"\0"}
    numbers = {256: columns, 257: rows, 258: 64, 259: _DEFLATE, 262: 1, 273: 8, 277: 1, 278: rows, 279: len(data), 339: 3}
    start, extra, entries = 8 + len(data) + len(data) % 2, b"", []
    after = start + 2 + 12 * (len(numbers) + len(blobs)) + 4
    for tag in sorted([*numbers, *blobs]):
        if tag in numbers:
            entries.append(struct.pack("<HHII", tag, 4, 1, numbers[tag]))
        else:
            blob, kind = blobs[tag], 2 if tag == 42113 else 12
            entries.append(struct.pack("<HHII", tag, kind, len(blob) // (1 if kind == 2 else 8), after + len(extra)))
            extra += blob + b"\0" * (len(blob) % 2)
    return b"II*\0" + struct.pack("<I", start) + data + b"\0" * (len(data) % 2) + struct.pack("<H", len(entries)) + b"".join(entries) + b"\0" * 4 + extra


def write_geotiff(cells: DataFrame, path: str, size: float = 1.0, side: int = 256, nodata: float = -9999.0) -> DataFrame:
    """Write cells (col, row, value) as one file a block of ``side`` by ``side`` cells; returns path and cells of the files written.

    Cells without a row, null and NaN are ``nodata``, which no value may be; of a cell that stands several times the largest value
    counts. Nothing is written before the result is used. A file gets its name when it is whole, and the same one when its task is run again.
    """
    block_of = [F.floor(F.col(c) / side).alias(f"_{c}") for c in ("col", "row")]
    plain = cells.groupBy("col", "row").agg(F.max(F.when(~F.isnan("value"), F.col("value").cast("double"))).alias("value")).select("*", *block_of)

    def write(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        grid = np.full((side, side), nodata)
        known = found[found["value"].notna()]
        grid[side - 1 - (known["row"].to_numpy() - key[1] * side), known["col"].to_numpy() - key[0] * side] = known["value"]
        system, folder = opened(path)
        system.create_dir(folder, recursive=True)
        name, own = f"{key[0]}_{key[1]}.tif", f"{folder}/{uuid4().hex}.part"
        with system.open_output_stream(own) as out:
            out.write(encoded(grid, key[0] * side * size, key[1] * side * size, size, nodata))
        system.move(own, f"{folder}/{name}")
        return pd.DataFrame({"path": [f"{path}/{name}"], "cells": [len(known)]})

    return plain.groupBy("_col", "_row").applyInPandas(write, "path string, cells bigint")
