import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from tarnworks.sources import geotiff


def _lzw(data):
    """Codes of a table that is emptied when it is full, written high bit first."""
    codes, table, word = [(256, 9)], {bytes([k]): k for k in range(256)}, b""
    following, width = 258, 9
    for byte in data:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        codes.append((table[word], width))
        table[longer] = following
        following, word = following + 1, bytes([byte])
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12  # entry 511 is there: ten bits
        if following == 4094:
            codes.append((256, width))
            table, following, width = {bytes([k]): k for k in range(256)}, 258, 9
    codes += [(table[word], width)] if word else []
    bits = "".join(f"{c:0{w}b}" for c, w in codes + [(257, width)])
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def _packbits(data):
    return b"".join(bytes([257 - 3, data[k]]) if data[k : k + 3] == data[k : k + 1] * 3 else bytes([len(data[k : k + 3]) - 1]) + data[k : k + 3] for k in range(0, len(data), 3))


def _tiff(values, order="<", big=False, tile=None, strip=3, compression=1, predictor=1, planar=1, nodata=None, corner=(10.0, 50.0), size=2.0, drop=()):
    """values: rows, columns, bands, as a file whose parts are encoded as asked."""
    rows, columns, bands = values.shape
    wide, high = tile or (columns, strip)
    kind = values.dtype.newbyteorder(order)
    layers = [values[:, :, [b]] for b in range(bands)] if planar == 2 else [values]
    parts = []
    for layer in layers:
        for top in range(0, rows, high):
            for left in range(0, columns, wide):
                part = layer[top : top + high, left : left + wide]
                if tile:
                    part = np.pad(part, ((0, high - part.shape[0]), (0, wide - part.shape[1]), (0, 0)))
                deep = part.shape[2]
                if predictor == 2:
                    part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
                data = part.astype(kind).tobytes()
                if predictor == 3:
                    planes = np.frombuffer(part.astype(kind.newbyteorder(">")).tobytes(), np.uint8).reshape(part.shape[0], -1, kind.itemsize).transpose(0, 2, 1).reshape(part.shape[0], -1, deep)
                    data = np.concatenate([planes[:, :1], planes[:, 1:] - planes[:, :-1]], axis=1).tobytes()
                data = {1: bytes, 5: _lzw, 8: zlib.compress, 32773: _packbits}[compression](data)
                parts.append(b"" if len(parts) in drop else data)
    body, offsets = b"\0" * 16, []
    for p in parts:
        offsets.append(len(body))
        body += p
    f = {"u": 1, "i": 2, "f": 3}[kind.kind]
    tags = [(256, "I", [columns]), (257, "I", [rows]), (258, "H", [kind.itemsize * 8] * bands), (259, "H", [compression]), (277, "H", [bands]), (284, "H", [planar]), (317, "H", [predictor]), (339, "H", [f] * bands)]
    tags += [(322, "I", [wide]), (323, "I", [high]), (324, "I", offsets), (325, "I", [len(p) for p in parts])] if tile else [(273, "I", offsets), (278, "I", [strip]), (279, "I", [len(p) for p in parts])]
    tags += [(33550, "d", [size, size, 0]), (33922, "d", [0, 0, 0, corner[0], corner[1] + rows * size, 0])]
    tags += [(42113, "s", nodata)] if nodata else []
    word, number = ("Q", "Q") if big else ("I", "H")
    types = {"s": 2, "H": 3, "I": 4, "d": 12}
    entries, extra, after = b"", b"", len(body) + struct.calcsize(order + number) + len(tags) * (20 if big else 12) + struct.calcsize(order + word)
    for tag, code, value in sorted(tags):
        blob = value + b"\0" if code == "s" else struct.pack(f"{order}{len(value)}{code}", *value)
        count = len(blob) if code == "s" else len(value)
        room = struct.calcsize(order + word)
        entries += struct.pack(f"{order}HH{word}", tag, types[code], count) + (blob.ljust(room, b"\0") if len(blob) <= room else struct.pack(order + word, after + len(extra)))
        extra += b"" if len(blob) <= room else blob
    name = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}H", 43 if big else 42) + (struct.pack(f"{order}HHQ", 8, 0, len(body)) if big else struct.pack(f"{order}I", len(body)))
    return name + body[len(name) :] + struct.pack(order + number, len(tags)) + entries + struct.pack(order + word, 0) + extra


def _cells(path, **options):
    """What the reader's tasks yield, without Spark."""
    source = geotiff.GeoTiff({"path": str(path), "filters": "true", **options})
    reader = source.reader(geotiff.CELLS)
    return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


RANDOM = np.random.default_rng(3)
SHAPES = {
    "strips": dict(), "tiles": dict(tile=(16, 16)), "big": dict(big=True, tile=(16, 16)), "motorola": dict(order=">", compression=8), "lzw": dict(compression=5, strip=17), "packbits": dict(compression=32773),
    "planes": dict(planar=2, tile=(16, 16), compression=8), "differences": dict(predictor=2, compression=8), "lzw differences": dict(predictor=2, compression=5, tile=(32, 32), order=">"),
}


@pytest.mark.parametrize("name", list(SHAPES))
@pytest.mark.parametrize("dtype", ["u1", "i2", "i4", "f4", "f8"])
def test_forms_of_files(tmp_path, name, dtype):
    options = SHAPES[name]
    values = RANDOM.integers(0, 120, (23, 37, 2)).astype(dtype)
    if dtype[0] == "f" and "differences" in name:
        options = {**options, "predictor": 3}
    (tmp_path / "a.tif").write_bytes(_tiff(values, **options))
    got = {(r["band"], r["col"], r["row"]): r["value"] for r in _cells(tmp_path / "a.tif", cells="50")}
    assert got == {(b + 1, c, 22 - r): float(values[r, c, b]) for b in range(2) for c in range(37) for r in range(23)}


def test_a_long_run_of_codes(tmp_path):
    values = (np.cumsum(RANDOM.integers(0, 9, (60, 400, 1)), axis=1) % 251).astype("u1")  # fills the table several times
    (tmp_path / "a.tif").write_bytes(_tiff(values, compression=5, strip=60))
    assert [r["value"] for r in _cells(tmp_path / "a.tif")] == values.ravel().tolist()


def test_missing_cells_and_places(spark, tmp_path):
    values = np.arange(40, dtype="f4").reshape(5, 8, 1)
    values[0, 0], values[1, 1] = np.nan, -3.4e38
    (tmp_path / "a.tif").write_bytes(_tiff(values, nodata=b"-3.4e+38", strip=2, drop=(2,)))
    (tmp_path / "b.tif").write_bytes(_tiff(values[:2] * 0 + 1, corner=(26.0, 50.0)))
    (tmp_path / "notes.txt").write_text("no grid")
    about = geotiff.head(str(tmp_path / "a.tif"))
    assert (about.x, about.y, about.dx, about.width, about.height) == (10.0, 50.0, 2.0, 8, 5)
    cells = geotiff.read_geotiff(spark, str(tmp_path), origin=(8.0, 46.0), cells=8)
    a = {(r.col, r.row): r.value for r in cells.where(F.col("path").endswith("a.tif")).collect()}
    assert len(a) == 40 and a[(1, 6)] is None and a[(2, 5)] is None and a[(3, 6)] == 2.0 and [a[(c, 2)] for c in range(1, 9)] == [None] * 8
    b = cells.where(F.col("path").endswith("b.tif"))
    assert b.agg(F.min("col"), F.max("col"), F.min("row")).first()[:] == (9, 16, 2)
    assert geotiff.read_geotiff(spark, str(tmp_path), ["value", "col"]).dtypes == [("value", "double"), ("col", "bigint")]
    (tmp_path / "c.tif").write_bytes(b"MM no")
    with pytest.raises(ValueError):
        geotiff.head(str(tmp_path / "c.tif"))


def test_windows_skip_tiles(spark, tmp_path):
    values = RANDOM.integers(0, 99, (64, 64, 1)).astype("i4")
    path = str(tmp_path / "a.tif")
    (tmp_path / "a.tif").write_bytes(_tiff(values, tile=(16, 16), compression=8))
    source = geotiff.GeoTiff({"path": path, "filters": "true", "cells": "256"})
    reader = source.reader(None)
    assert len(reader.partitions()) == 16
    rules = [D.GreaterThanOrEqual(("col",), 20), D.LessThan(("col",), 30), D.EqualTo(("row",), 5), D.GreaterThan(("value",), 3.0)]
    assert list(reader.pushFilters(rules)) == rules
    assert [p.parts[0][0] for p in reader.partitions()] == [13]  # second column, last row of tiles
    window = geotiff.read_geotiff(spark, path).where("col BETWEEN 20 AND 35 AND row <= 17 AND row > 3")
    assert {(r.col, r.row): r.value for r in window.collect()} == {(c, r): float(values[63 - r, c, 0]) for c in range(20, 36) for r in range(4, 18)}
    assert geotiff.read_geotiff(spark, path).where("col > 1000").count() == 0


def test_blocks_written_by_tasks(spark, tmp_path):
    path = "file://" + str(tmp_path / "grid")
    cells = [(c, r, float(c * 100 + r) if (c + r) % 5 else None) for c in range(-3, 20) for r in range(-9, 9)] + [(0, 1, -1.0), (0, 2, float("nan"))]
    written = geotiff.write_geotiff(spark.createDataFrame(cells, "col bigint, row bigint, value double"), path, 0.5, side=8).collect()
    assert sorted(f.name for f in (tmp_path / "grid").iterdir()) == sorted(w.path.rsplit("/", 1)[1] for w in written) and sum(w.cells for w in written) == sum(v is not None for _, _, v in cells[:-2])
    got = {(r.col, r.row): r.value for r in geotiff.read_geotiff(spark, path, origin=(0.0, 0.0)).where("value IS NOT NULL").collect()}
    assert got == {(c, r): v for c, r, v in cells[:-2] if v is not None}
