"""GeoPackage containers: layers read as DataFrames by ranges of row ids, subsets written as one file or a file a task.

``read_container(spark, path, layer, columns)`` reads a layer; conditions on it reach the containers'
own SQL, where their indexes can serve them. ``spark.dataSource.register(GeoPackage)`` makes
``spark.read.format("geopackage").option("layer", name).load(path)`` available too. A path is a container, or
a folder of containers with the same layers, as ``write_containers`` makes. Containers are database files, so
their path must be one that every executor sees as a file, and values are taken to have their
column's declared type, as the standard demands.
"""

from __future__ import annotations

import json
import math
import os
import re
import sqlite3
import struct
from contextlib import closing
from dataclasses import dataclass
from glob import escape, glob
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import datasource as D
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tarnworks.functions.geometry import NAMES, SRID, parse, to_blob
from tarnworks.sources.layers import catalog, geometry_column

_TYPES = {"INTEGER": T.LongType(), "INT": T.LongType(), "MEDIUMINT": T.LongType(), "BOOLEAN": T.LongType(), "REAL": T.DoubleType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BLOB": T.BinaryType()}
_GEOMETRY = {"GEOMETRY", "GEOMETRYCOLLECTION", *(n.upper() for n in NAMES.values())}


def _file(path: str) -> str:
    return re.sub("^file:(//)?", "", path)


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{_file(path)}?mode=ro", uri=True)


def _containers(path: str) -> list[str]:
    """The files of a path, in the order of their names."""
    path = _file(path)
    found = sorted(glob(f"{escape(path)}/*.gpkg")) if os.path.isdir(path) else [path]
    if not found:
        raise FileNotFoundError(f"no containers in {path}")
    return found


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Range(InputPartition):
    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


@dataclass(frozen=True)
class _Condition:
    """A condition as SQL, with the values of its marks."""

    sql: str
    values: tuple = ()


_COMPARED = {D.EqualTo: "=", D.EqualNullSafe: "IS", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}


def condition(rule: D.Filter, kinds: dict[str, T.DataType]) -> _Condition | None:
    """A pushed filter in the containers' SQL, None where it would not mean the same there.

    Texts compare by their bytes on both sides, whatever collation a column declares. Columns whose
    declared type is none of the known ones, bytes, and values that are not finite are left to Spark.
    """
    if isinstance(rule, D.Not):
        inner = condition(rule.child, kinds)
        return inner and _Condition(f"NOT ({inner.sql})", inner.values)
    name = ".".join(rule.attribute)
    column = _quoted(name)
    if len(rule.attribute) != 1 or name not in kinds:
        return None
    if isinstance(rule, (D.IsNull, D.IsNotNull)):
        return _Condition(f"{column} IS {'NOT ' if isinstance(rule, D.IsNotNull) else ''}NULL")
    textual = isinstance(kinds[name], T.StringType)
    fits = lambda v: isinstance(v, str) and "\0" not in v if textual else isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v)
    if not textual and not isinstance(kinds[name], (T.LongType, T.DoubleType)):
        return None
    binary = " COLLATE BINARY" if textual else ""
    if isinstance(rule, D.In):
        if not all(v is None or fits(v) for v in rule.value):
            return None
        # one value however long the list is
        return _Condition(f"{column}{binary} IN (SELECT value FROM json_each(?))", (json.dumps(list(rule.value)),))
    if not fits(rule.value):
        return None
    if type(rule) in _COMPARED:
        return _Condition(f"{column} {_COMPARED[type(rule)]} ?{binary}", (rule.value,))
    if isinstance(rule, D.StringStartsWith):
        return _Condition(f"{column} >= ?{binary} AND substr({column}, 1, ?) = ?{binary}", (rule.value, len(rule.value), rule.value))
    if isinstance(rule, D.StringEndsWith) and rule.value:
        return _Condition(f"substr({column}, ?) = ?{binary}", (-len(rule.value), rule.value))
    if isinstance(rule, D.StringContains):
        return _Condition(f"instr({column}, ?) > 0", (rule.value,))
    return None


class _Reader(DataSourceReader):
    def __init__(self, path: str, layer: str, schema: T.StructType, kinds: dict[str, T.DataType], row_id: str | None, parts: int):
        self.path, self.layer, self.schema, self.kinds, self.row_id, self.parts = path, layer, schema, kinds, row_id, parts
        self.where: list[_Condition] = []
        self.bounds: list[_Condition] = []

    def statement(self, columns: str, conditions: list[_Condition]) -> tuple[str, list]:
        where = " AND ".join(f"({c.sql})" for c in conditions)
        return f"SELECT {columns} FROM {_quoted(self.layer)}{' WHERE ' if where else ''}{where}", [v for c in conditions for v in c.values]

    def partitions(self) -> list[_Range]:
        """Ranges of row ids, ``parts`` in all and one a container at least; filters on the row id narrow them, without a scan."""
        spans = []
        for path in _containers(self.path):
            with closing(_open(path)) as db:
                low, high = db.execute(*self.statement("coalesce(min(rowid), 0), coalesce(max(rowid), -1)", self.bounds)).fetchone()
            spans.append((path, low, high))
        step = max(1, -(-sum(high - low + 1 for _, low, high in spans) // self.parts))
        return [_Range(path, k, min(k + step, high + 1)) for path, low, high in spans for k in range(low, high + 1, step)] or [_Range(spans[0][0], 0, 0)]

    def read(self, partition: _Range):
        columns = ", ".join(_quoted(f.name) for f in self.schema) or "1"
        kinds = [f.dataType for f in self.schema]
        schema = pa.schema([(f.name, _ARROW[type(f.dataType)]) for f in self.schema])
        own = _Condition("rowid >= ? AND rowid < ?", (partition.low, partition.high))
        with closing(_open(partition.path)) as db:
            found = db.execute(*self.statement(columns, [own, *self.where]))
            while rows := found.fetchmany(4096):
                yield pa.RecordBatch.from_arrays([pa.array([_value(v, k) for v in column], t) for column, k, t in zip(zip(*rows), kinds, schema.types)], schema=schema)


class _FilteringReader(_Reader):
    """Spark calls this one's ``pushFilters`` only where its setting for that is on, and refuses it elsewhere."""

    def pushFilters(self, filters):
        for rule in filters:
            pushed = condition(rule, self.kinds)
            if pushed is None:
                yield rule
                continue
            self.where.append(pushed)
            if getattr(rule, "attribute", None) == (self.row_id,) and isinstance(rule, (*_COMPARED, D.In)):
                self.bounds.append(pushed)


_ARROW = {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BinaryType: pa.binary(), T.StringType: pa.string()}


def _value(value, kind: T.DataType):
    if value is None or isinstance(kind, T.BinaryType):
        return value
    return str(value) if isinstance(kind, T.StringType) else float(value) if isinstance(kind, T.DoubleType) else int(value)


def _kind(declared: str) -> T.DataType:
    return T.BinaryType() if declared.upper() in _GEOMETRY else _TYPES.get(declared.upper().split("(")[0], T.StringType())


class GeoPackage(DataSource):
    """Options: layer, partitions (8), filters ("true": push them; needs ``spark.sql.python.filterPushdown.enabled``).

    A schema of some of the layer's columns reads these alone.
    """

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _columns(self) -> list[tuple]:
        with closing(_open(_containers(self.options["path"])[0])) as db:
            columns = db.execute(f"PRAGMA table_info({_quoted(self.options['layer'])})").fetchall()
        if not columns:
            raise ValueError(f"no layer {self.options['layer']}")
        return columns

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c[1], _kind(c[2])) for c in self._columns()])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        columns = self._columns()
        # other declared types compare texts and numbers by rules of their own
        kinds = {c[1]: _kind(c[2]) for c in columns if not isinstance(_kind(c[2]), T.StringType) or re.search("CHAR|CLOB|TEXT", c[2].upper())}
        keys = [c[1] for c in columns if c[5] and c[2].upper() == "INTEGER"]
        row_id = keys[0] if len([c for c in columns if c[5]]) == 1 and keys else None
        made = _FilteringReader if self.options.get("filters") == "true" else _Reader
        return made(self.options["path"], self.options["layer"], schema, kinds, row_id, int(self.options.get("partitions", 8)))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("containers are written to a folder that does not exist yet; overwriting is not supported")
        return _Writer(_file(self.options["path"]), self.options["layer"], schema)


def read_container(spark: SparkSession, path: str, layer: str, columns: list[str] | None = None, partitions: int = 8) -> DataFrame:
    """A layer of a container, or of a folder of containers; only ``columns`` are read, and filters that follow reach the file."""
    spark.dataSource.register(GeoPackage)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    schema = GeoPackage({"path": path, "layer": layer}).schema()
    if columns is not None:
        schema = T.StructType([schema[c] for c in columns])
    return spark.read.format("geopackage").schema(schema).options(layer=layer, partitions=partitions, filters="true").load(path)


def write_containers(layer: DataFrame, path: str, name: str) -> None:
    """A layer as a folder of containers, one a task, written where the rows are; the folder must not exist.

    Geometry (WKB) becomes blobs, a ``fid`` stays and others get one within their container. A task that is run
    again writes a new file, and only files of tasks that count are given their names in the end. Each container has
    its own extent and feature count, and a layer without rows is one container without rows.
    """
    spark = layer.sparkSession
    spark.dataSource.register(GeoPackage)
    if os.path.exists(_file(path)):
        raise FileExistsError(path)
    geom = geometry_column(layer)
    rows = layer.withColumn(geom, to_blob(F.col(geom))) if geom else layer
    rows.write.format("geopackage").mode("append").option("layer", name).save(path)


class _Written(WriterCommitMessage):
    def __init__(self, file: str | None):
        self.file = file


class _Writer(DataSourceWriter):
    def __init__(self, path: str, layer: str, schema: T.StructType):
        self.path, self.layer, self.schema = path, layer, schema

    def _container(self, rows) -> str:
        os.makedirs(self.path, exist_ok=True)
        file = f"{self.path}/{uuid4().hex}.part"
        with closing(sqlite3.connect(file)) as db, db:
            db.executescript(_SPATIAL)
            geom = next((f.name for f in self.schema if f.name in ("geom", "geometry") and isinstance(f.dataType, T.BinaryType)), None)
            _create(db, self.layer, list(self.schema), geom)
            found = _Extent([f.name for f in self.schema].index(geom) if geom else None)
            db.executemany(_insertion(self.layer, [f.name for f in self.schema]), map(found.seen, rows))
            about = ("features" if geom else "attributes", found.count, *found.box)
            _register(db, self.layer, about, geom, found.shape)
        return file

    def write(self, iterator) -> WriterCommitMessage:
        rows = iter(iterator)
        first = next(rows, None)
        if first is None:
            return _Written(None)
        return _Written(self._container(row for part in ([first], rows) for row in part))

    def commit(self, messages) -> None:
        files = [m.file for m in messages if m is not None and m.file] or [self._container(iter(()))]
        for k, file in enumerate(sorted(files)):
            os.rename(file, f"{self.path}/{k:05d}.gpkg")

    def abort(self, messages) -> None:
        for message in messages:
            if message is not None and message.file and os.path.exists(message.file):
                os.remove(message.file)


#: The tables and first rows that the GeoPackage standard prescribes, and the feature counts that readers of it look for.
_SPATIAL = """
PRAGMA application_id = 0x47504B47;
PRAGMA user_version = 10300;
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
INSERT INTO gpkg_spatial_ref_sys VALUES ('Undefined cartesian', -1, 'NONE', -1, 'undefined', NULL), ('Undefined geographic', 0, 'NONE', 0, 'undefined', NULL), ('WGS 84 geodetic', 4326, 'EPSG', 4326, 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433],AUTHORITY["EPSG","4326"]]', NULL), ('NAD83 / Conus Albers', 5070, 'EPSG', 5070, 'EPSG:5070', NULL);
CREATE TABLE gpkg_ogr_contents (table_name TEXT NOT NULL PRIMARY KEY, feature_count INTEGER DEFAULT NULL);
"""


def _declared(kind: T.DataType) -> str:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return "INTEGER"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "REAL"
    return "BLOB" if isinstance(kind, T.BinaryType) else "TEXT"


def _create(db: sqlite3.Connection, name: str, fields: list[T.StructField], geom: str | None) -> None:
    columns = "".join(f", {_quoted(f.name)} {'GEOMETRY' if f.name == geom else _declared(f.dataType)}" for f in fields if f.name != "fid")
    db.execute(f"CREATE TABLE {_quoted(name)} (fid INTEGER PRIMARY KEY AUTOINCREMENT{columns})")


def _insertion(name: str, columns: list[str]) -> str:
    return f"INSERT INTO {_quoted(name)} ({', '.join(map(_quoted, columns))}) VALUES ({', '.join('?' * len(columns))})"


def _register(db: sqlite3.Connection, name: str, about: tuple, geom: str | None, shape: str) -> None:
    """The catalogue rows of a layer; ``about``: data type, feature count, extent."""
    kind, count, *box = about
    db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, min_x, min_y, max_x, max_y, srs_id) VALUES (?, ?, ?, ?, ?, ?, ?, ?)", (name, kind, name, *box, SRID if geom else None))
    db.execute("INSERT INTO gpkg_ogr_contents VALUES (?, ?)", (name, count))
    if geom:
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, ?, ?, 0, 0)", (name, geom, shape, SRID))


def _plain(v):
    return bytes(v) if isinstance(v, bytearray) else v if isinstance(v, (int, float, str, bytes, type(None))) else str(v)


class _Extent:
    """Rows made plain as they pass, counted, with the extent and the kind of their geometry blobs."""

    def __init__(self, place: int | None):
        self.place, self.count, self.low, self.high, self.kinds = place, 0, [math.inf] * 2, [-math.inf] * 2, set()

    def seen(self, row) -> list:
        row, self.count = [_plain(v) for v in row], self.count + 1
        blob = row[self.place] if self.place is not None else None
        if blob is not None and blob[:2] == b"GP":
            boxed = blob[3] & 14
            if boxed == 2:
                x0, x1, y0, y1 = struct.unpack_from("<4d", blob, 8)
                self.low, self.high = [min(self.low[0], x0), min(self.low[1], y0)], [max(self.high[0], x1), max(self.high[1], y1)]
            found = parse(blob[40 if boxed == 2 else 8 :])
            self.kinds.add(NAMES.get(found[0], "Geometry").upper() if found else "GEOMETRY")
        return row

    @property
    def box(self) -> list:
        return [None if math.isinf(v) else v for v in (*self.low, *self.high)]

    @property
    def shape(self) -> str:
        return self.kinds.pop() if len(self.kinds) == 1 else "GEOMETRY"


def write_geopackage(layers: dict[str, DataFrame], path: str) -> None:
    """Write a subset's layers to one file on the driver.

    For exports that a person downloads: rows pass one by one, in the order of the
    layers' partitions, and counts and extents come from Spark. A layer's ``fid`` stays;
    others get one. Empty layers are written with their columns. Whole networks stay in Parquet.
    """
    rows_of = {r.table_name: r for r in catalog(layers).collect()}  # a row a layer
    with closing(sqlite3.connect(path)) as db, db:
        db.executescript(_SPATIAL)
        for name, layer in layers.items():
            geom, about = geometry_column(layer), rows_of[name]
            rows = layer.withColumn(geom, to_blob(F.col(geom))) if geom else layer
            _create(db, name, list(rows.schema), geom)
            insertion = _insertion(name, rows.columns)
            for row in rows.toLocalIterator():
                db.execute(insertion, [_plain(v) for v in row])
            first = layer.where(F.col(geom).isNotNull()).select(geom).first() if geom else None
            shape = parse(bytes(first[0])) if first else None
            extent = (about.data_type, about.feature_count, about.minx, about.miny, about.maxx, about.maxy)
            _register(db, name, extent, geom, NAMES.get(shape[0], "Geometry").upper() if shape else "GEOMETRY")
