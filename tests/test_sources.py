import gzip
import json
import struct
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnworks.functions import geometry as g
from tarnworks.sources import files, layers
from tarnworks.sources.geopackage import GeoPackage, condition, read_container, write_containers, write_geopackage

POINT = struct.pack("<BIdd", 1, 1, 1.5, -2.0)
BIG = struct.pack(">BIdd", 0, 1, 1.5, -2.0)
LINE = struct.pack("<BII4d", 1, 2, 2, 0.0, 1.0, 4.0, 5.0)
HOLE = g.write_polygon([[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(9, 9), (1, 1), (2, 2), (9, 9)]])


def many(kind, *parts):
    return struct.pack("<BII", 1, kind, len(parts)) + b"".join(parts)


def test_bounds_of_every_type():
    assert g.bounds_of(POINT) == g.bounds_of(BIG) == (1.5, -2.0, 1.5, -2.0)
    assert g.bounds_of(LINE) == (0, 1, 4, 5) and g.bounds_of(HOLE) == (0, 0, 4, 4)
    assert g.bounds_of(many(4, POINT, BIG)) == (1.5, -2, 1.5, -2) and g.bounds_of(many(7, HOLE, many(5, LINE))) == (0, 0, 4, 5)
    assert g.bounds_of(struct.pack("<BIdd", 1, 0x20000001, 1.0, 2.0)) == (1, 2, 1, 2)
    assert g.bounds_of(many(5, LINE, struct.pack("<BII", 1, 2, 0))) == (0, 1, 4, 5) and g.bounds_of(many(6, many(3), HOLE)) == (0, 0, 4, 4)
    for bad in (None, b"", b"\x01", POINT[:-1], many(3), struct.pack("<BIdd", 1, 1, float("nan"), 1), many(7, struct.pack("<BI", 1, 99)), struct.pack("<BII", 1, 2, 2**31)):
        assert g.bounds_of(bad) is None


finite = st.floats(-1e6, 1e6)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(finite, finite), min_size=1, max_size=9))
def test_blob_header_keeps_the_geometry(points):
    data = struct.pack(f"<BII{2 * len(points)}d", 1, 2, len(points), *(v for xy in points for v in xy))
    assert g.parse(data) == (2, points)
    box = g.bounds_of(data)
    blob = struct.pack("<2sBBi4d", b"GP", 0, 3, 5070, box[0], box[2], box[1], box[3]) + data
    assert g.bounds_of(blob) == box


def test_codecs_in_spark(spark):
    blobs = [POINT, LINE, HOLE, None, b"junk"]
    table = spark.createDataFrame(list(enumerate(blobs)), "k int, geom binary").withColumn("blob", g.to_blob("geom"))
    back = {r.k: r.back for r in table.select("k", g.from_blob(F.col("blob")).alias("back")).collect()}
    assert [None if back[k] is None else bytes(back[k]) for k in range(5)] == blobs
    assert bytes(table.select(g.to_blob("blob").alias("b")).first().b) == bytes(table.first().blob)
    for env, size in enumerate((0, 32, 48, 48, 64)):
        raw = struct.pack("<2sBBi", b"GP", 0, env << 1, 5070) + b"\0" * size + POINT
        assert bytes(spark.createDataFrame([(raw,)], "b binary").select(g.from_blob(F.col("b")).alias("x")).first().x) == POINT and g.parse(raw) == g.parse(POINT)
    shown = table.select("k", g.geojson(F.col("geom"), project=False).alias("s")).select("k", "s.*").orderBy("k").collect()
    assert json.loads(shown[2].json)["type"] == "Polygon" and shown[2].maxx == 4 and shown[3].json is None and shown[4].json is None
    centres = table.select("k", g.centroid("geom").alias("c")).orderBy("k").collect()
    assert (centres[0].c.x, centres[0].c.y) == (1.5, -2.0) and centres[4].c.x is None


def test_albers_column_is_the_scalar(spark):
    at = spark.createDataFrame([(0.0, 0.0), (-1e6, 1.5e6), (2e6, 3e5)], "x double, y double").select("x", "y", g.albers_inverse(F.col("x"), F.col("y")).alias("p")).collect()
    for r in at:
        assert (r.p.lon, r.p.lat) == pytest.approx(g.lon_lat(r.x, r.y), abs=1e-9)
    assert (at[0].p.lon, at[0].p.lat) == pytest.approx((-96, 23), abs=1e-9)


def test_geopackage_round_trip(spark, tmp_path):
    path = str(tmp_path / "subset.gpkg")
    divides = spark.createDataFrame([(f"cat-{k}", k, k / 2, POINT if k else None) for k in range(30)], "divide_id string, n int, area double, geom binary")
    write_geopackage({"divides": divides, "lakes": layers.empty_layer(spark, "lakes"), "pois": layers.empty_layer(spark, "pois")}, path)
    spark.dataSource.register(GeoPackage)
    read = spark.read.format("geopackage").option("layer", "divides").option("partitions", 4).load(path)
    assert dict(read.dtypes) == {"fid": "bigint", "divide_id": "string", "n": "bigint", "area": "double", "geom": "binary"}
    assert sorted((r.divide_id, r.n, r.area) for r in read.collect()) == sorted((f"cat-{k}", k, k / 2) for k in range(30))
    assert bytes(read.where("n = 3").select(g.from_blob(F.col("geom")).alias("g")).first().g) == POINT
    empty = spark.read.format("geopackage").option("layer", "lakes").load(path)
    assert empty.count() == 0 and dict(empty.dtypes)["lake_id"] == "double"
    assert len(empty.columns) == 24 + ("fid" in empty.columns) and len([c for c in empty.columns if c.startswith("reservoir_index_")]) == 5
    about = spark.read.format("geopackage").option("layer", "gpkg_contents").load(path).where("table_name = 'divides'").first()
    assert (about.data_type, about.min_x, about.max_y) == ("features", 1.5, -2.0)


def test_geopackage_keeps_fid_and_counts(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "fid.gpkg")
    write_geopackage({"nexus": spark.createDataFrame([(70, "nex-1"), (7, "nex-2")], "fid bigint, id string"), "lakes": layers.empty_layer(spark, "lakes")}, path)
    db = sqlite3.connect(path)
    assert db.execute("SELECT fid, id FROM nexus ORDER BY fid").fetchall() == [(7, "nex-2"), (70, "nex-1")]
    assert db.execute("SELECT table_name, feature_count FROM gpkg_ogr_contents ORDER BY 1").fetchall() == [("lakes", 0), ("nexus", 2)]
    assert {r[0] for r in db.execute("SELECT srs_id FROM gpkg_spatial_ref_sys")} == {-1, 0, 4326, 5070}
    db.close()


def _container(spark, path):
    rows = [(k, f"cat-{k}", k % 3 if k % 5 else None, k / 2, None if k % 7 == 0 else "éA%_"[k % 4 :]) for k in range(200)]
    write_geopackage({"divides": spark.createDataFrame(rows, "fid bigint, divide_id string, n int, area double, t string")}, path)


FILTERS = [
    "divide_id = 'cat-7'", "n IS NULL", "n IS NOT NULL AND area > 50", "n <=> 1", "NOT (n = 1)", "n <> 2", "n IN (0, 2, 9)", "n NOT IN (0, 2)", "n NOT IN (0, NULL)", "area IN (1.5, 3.0, 1e300)",
    "t LIKE 'é%'", "t LIKE '%_'", "t LIKE '%A%'", "t >= 'A'", "t < 'a'", "t = 'éa%_'", "fid BETWEEN 20 AND 30", "fid = 3 AND t LIKE '%\\\\_'", "fid < -1", "area < double('NaN')", "area > 2 OR n = 1", "fid % 7 = 0 AND fid > 100",
]


def test_pushed_filters_keep_the_rows(spark, tmp_path):
    path = str(tmp_path / "f.gpkg")
    _container(spark, path)
    read, plain = read_container(spark, path, "divides", partitions=3), spark.createDataFrame(spark.read.format("geopackage").option("layer", "divides").load(path).collect(), "fid bigint, divide_id string, n bigint, area double, t string")
    for rule in FILTERS:
        assert sorted(map(str, read.where(rule).collect())) == sorted(map(str, plain.where(rule).collect())), rule
    assert read.where(F.col("divide_id").isin([f"cat-{k}" for k in range(0, 90000, 2)])).count() == 100


def test_filters_and_columns_reach_the_container(spark, tmp_path):
    import sqlite3

    from pyspark.sql import datasource as D

    path = str(tmp_path / "p.gpkg")
    _container(spark, path)
    few = read_container(spark, path, "divides", ["divide_id", "n"]).where("n = 1 AND divide_id LIKE 'cat-1%' AND length(divide_id) = 5")
    assert few.columns == ["divide_id", "n"] and [r.divide_id for r in few.collect()] == ["cat-1"]
    source = GeoPackage({"path": path, "layer": "divides", "filters": "true", "partitions": "4"})
    reader = source.reader(source.schema())
    rules = [D.EqualTo(("n",), 1), D.GreaterThanOrEqual(("fid",), 180), D.EqualTo(("t",), "a\0b"), D.In(("n",), (1, None))]
    assert list(reader.pushFilters(rules)) == [rules[2]]
    statement, values = reader.statement('"n"', reader.where)
    assert statement == 'SELECT "n" FROM "divides" WHERE ("n" = ?) AND ("fid" >= ?) AND ("n" IN (SELECT value FROM json_each(?)))' and values == [1, 180, "[1, null]"]
    parts = reader.partitions()
    assert (parts[0].low, parts[-1].high, len(parts)) == (180, 200, 4)
    got = [r for p in parts for batch in reader.read(p) for r in batch.to_pylist()]
    assert [r["fid"] for r in got] == [k for k in range(180, 200) if k % 5 and k % 3 == 1]
    # an index of the container serves the pushed condition
    db = sqlite3.connect(path)
    db.execute("CREATE INDEX by_divide ON divides (divide_id)")
    pushed = condition(D.EqualTo(("divide_id",), "cat-7"), reader.kinds)
    assert "by_divide" in str(db.execute(f"EXPLAIN QUERY PLAN SELECT * FROM divides WHERE {pushed.sql}", pushed.values).fetchall())
    db.close()


def test_containers_by_task(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "parts")
    divides = spark.createDataFrame([(f"cat-{k}", k, k / 2, POINT if k else None) for k in range(30)], "divide_id string, n int, area double, geom binary").repartition(3)
    write_containers(divides, path, "divides")
    files = sorted(f.name for f in (tmp_path / "parts").iterdir())
    assert files == [f"{k:05d}.gpkg" for k in range(3)]
    read = read_container(spark, path, "divides", partitions=5)
    assert sorted((r.divide_id, r.n, r.area) for r in read.collect()) == sorted((f"cat-{k}", k, k / 2) for k in range(30))
    assert bytes(read.where("n = 3").select(g.from_blob(F.col("geom")).alias("g")).first().g) == POINT and read.where("n = 0").first().geom is None
    counts = []
    for name in files:
        with sqlite3.connect(tmp_path / "parts" / name) as db:
            counts.append(db.execute("SELECT feature_count FROM gpkg_ogr_contents").fetchone()[0])
            assert db.execute("SELECT min_x, max_y, data_type FROM gpkg_contents").fetchone() == (1.5, -2.0, "features")
            assert db.execute("SELECT geometry_type_name FROM gpkg_geometry_columns").fetchone() == ("POINT",)
    assert sum(counts) == 30 and min(counts) > 0
    with pytest.raises(FileExistsError):
        write_containers(divides, path, "divides")
    none = str(tmp_path / "none")
    write_containers(layers.empty_layer(spark, "lakes"), none, "lakes")
    assert read_container(spark, none, "lakes").count() == 0


def test_layers(spark, tmp_path):
    root = "file://" + str(tmp_path)
    both = spark.createDataFrame([(1, "a", "16"), (2, "b", "17")], "n bigint, t string, vpuid string")
    layers.write_layer(both, root, "divides")
    assert [r.n for r in layers.read_layer(spark, root, "divides", ["17"]).collect()] == [2]
    for ids in ([1], list(range(1, 40, 2))):
        assert [r.n for r in layers.read_ids(spark, f"{root}/divides", "n", ids).collect()] == [1]
    shown = layers.for_display(spark.createDataFrame([(b"abc", b"\x01")], "name binary, geom binary"))
    assert shown.dtypes == [("name", "string"), ("geom", "binary")]


def test_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text("# about\nflowpath_id,flowpath_toid,lengthkm,areasqkm,totdasqkm,pathlength,streamorder\n1,2,,3.5,,,4 # note\n\n1,,7.0,,,,\n")
    got = files.read_corrections(spark, str(tmp_path / "c.csv")).orderBy("ord").collect()
    assert [(r.flowpath_id, r.flowpath_toid, r.lengthkm, r.areasqkm, r.streamorder) for r in got] == [(1, 2, None, 3.5, 4), (1, None, 7.0, None, None)]
    (tmp_path / "g.json").write_text('{"meta": {"total_edges": 2},\n "edges": [[0, 1, 3, 2], [2, 5, 1, 1]]}')
    assert [tuple(r) for r in files.read_edges(spark, str(tmp_path / "g.json")).orderBy("pos").collect()] == [(0, 1, 3, 2, 0), (2, 5, 1, 1, 1)]
    (tmp_path / "d.asc").write_text("ncols 3\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 1\nNODATA_value -9999\n1 2 3\n4 -9999 6\n")
    cells = {(r.col, r.row): r.value for r in files.read_ascii_grid(spark, str(tmp_path / "d.asc")).collect()}
    assert cells == {(0, 1): 1, (1, 1): 2, (2, 1): 3, (0, 0): 4, (1, 0): None, (2, 0): 6}
    assert files.read_texts(spark, str(tmp_path), "*.csv").count() == 1


def test_texts_are_written_where_the_rows_are(spark, tmp_path):
    odd = "file://" + str(tmp_path / "a b" / "é%.txt")
    texts = spark.createDataFrame([(f"file://{tmp_path}/x/1.txt", "one\n"), (f"{tmp_path}/2.txt", "zwei é"), (f"{tmp_path}/3.txt", None), (odd.replace("%", "%25"), "")], "path string, text string")
    assert sorted(r.bytes for r in files.write_texts(texts).collect()) == [0, 4, 7]
    assert (tmp_path / "x" / "1.txt").read_text() == "one\n" and (tmp_path / "2.txt").read_text() == "zwei é" and not (tmp_path / "3.txt").exists() and (tmp_path / "a b" / "é%.txt").read_text() == ""
    read = files.read_texts(spark, str(tmp_path), "*.txt").withColumn("text", F.concat("text", F.lit("!")))
    files.write_texts(read.where("text like 'one%' or text like 'zwei%'")).collect()
    assert (tmp_path / "x" / "1.txt").read_text() == "one\n!" and (tmp_path / "2.txt").read_text() == "zwei é!"


def test_staged_tables_are_cleared(spark):
    from tarnworks import session

    before = session._MADE.pop(spark.sparkContext.applicationId, [])  # other tests still read theirs
    paths = [session.staged(spark.range(3), "cleared").inputFiles()[0] for _ in range(2)]
    kept = session.staged_by(spark.range(9), "id", "cleared")
    assert kept.count() == 9 and all(Path(p.removeprefix("file://")).exists() for p in paths)
    assert session.clear_staged(spark) == 3 and session.clear_staged(spark) == 0
    assert not any(Path(p.removeprefix("file://")).parent.exists() for p in paths)
    session._MADE[spark.sparkContext.applicationId] = before


def test_texts_are_listed_and_read_by_tasks(spark, tmp_path):
    names = ["a.txt", "b c/d%.txt", "b c/é/[e].txt", "b c/.h.txt", "_g/f.txt", "b c/i.md", "k=1/j.tsv", "b c/é/l.txt.gz"]
    for k, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(gzip.compress(f"text {k}\r\n".encode()) if name.endswith(".gz") else f"text {k}\r\n".encode())
    for pattern, found in (("*.txt", [0, 1, 2]), ("*.{txt,md}", [0, 1, 2, 5]), ("?.t[sx][vt]", [0, 6]), ("*.gz", [7])):
        for folder in (str(tmp_path), f"file://{tmp_path}"):
            read = files.read_texts(spark, folder, pattern)
            # the driver knows the files of the listing, and none of those listed
            assert not any(str(tmp_path) in p for p in read.inputFiles())
            want = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder, wholetext=True).select(F.input_file_name(), "value")
            got = sorted(map(tuple, read.collect()))
            assert got == sorted(map(tuple, want.collect())) and sorted(t for _, t in got) == [f"text {k}\r\n" for k in found]
    assert files.read_texts(spark, str(tmp_path), "*.none").count() == 0
