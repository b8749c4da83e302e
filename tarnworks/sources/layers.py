"""Layers as Parquet folders, partitioned by processing region where they have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns and types of three layers that are written even when empty.
EMPTY = {
    "hydrolocations": "poi_id int, id string, nex_id string, hf_id double, hl_link string, hl_reference string, hl_uri string, hl_source string, hl_x double, hl_y double, vpuid string, geom binary",
    "pois": "poi_id int, id string, nex_id string, vpuid string",
    "lakes": "geom binary, lake_id double, LkArea double, LkMxE double, WeirC double, WeirL double, OrificeC double, OrificeA double, OrificeE double, WeirE double, ifd double, Dam_Length double, domain string, poi_id int, hf_id double, reservoir_index_AnA double, reservoir_index_Extended_AnA double, reservoir_index_GDL_AK double, reservoir_index_Medium_Range double, reservoir_index_Short_Range double, res_id string, vpuid string, lake_x double, lake_y double",
}


def read_layer(spark: SparkSession, root: str, name: str, vpuids: list[str] | None = None) -> DataFrame:
    """A layer, or only some of its regions (other regions' files are not read)."""
    layer = spark.read.parquet(f"{root}/{name}")
    return layer.where(F.col("vpuid").isin(*vpuids)) if vpuids else layer


def read_ids(spark: SparkSession, path: str, column: str, ids: list, most: int = 10) -> DataFrame:
    """Rows whose column is among ids: a few as a filter that reaches the scan, more by a semi join."""
    table = spark.read.parquet(path)
    if len(ids) <= most:
        return table.where(F.col(column).isin(*ids))
    kind = table.schema[column].dataType
    wanted = spark.createDataFrame([(i,) for i in ids], T.StructType([T.StructField("_id", kind)]))
    return table.join(wanted, F.col(column) == F.col("_id"), "left_semi")


def write_layer(layer: DataFrame, root: str, name: str, mode: str = "overwrite") -> None:
    """Replace (or append to) one layer; the others in the folder stay."""
    writer = layer.write.mode(mode)
    (writer.partitionBy("vpuid") if "vpuid" in layer.columns else writer).parquet(f"{root}/{name}")


def empty_layer(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], EMPTY[name])


def geometry_column(layer: DataFrame) -> str | None:
    return next((c for c in ("geom", "geometry") if c in layer.columns), None)


def for_display(layer: DataFrame) -> DataFrame:
    """Byte columns as text, but for the geometry."""
    keep = geometry_column(layer)
    return layer.select(*[F.decode(f.name, "utf-8").alias(f.name) if f.dataType == T.BinaryType() and f.name != keep else F.col(f.name) for f in layer.schema])


def catalog(layers: dict[str, DataFrame]) -> DataFrame:
    """A row a layer: table_name, data_type, feature_count and the extent of its geometries."""
    from tarnworks.functions.geometry import bounds
    from tarnworks.operators.aggregates import extent

    rows = []
    for name, layer in layers.items():
        geom = geometry_column(layer)
        box = bounds(geom) if geom else F.lit(None).cast("struct<minx:double,miny:double,maxx:double,maxy:double>")
        kind = F.lit("features" if geom else "attributes").alias("data_type")
        rows.append(layer.select(box.alias("_box")).agg(F.count(F.lit(1)).alias("feature_count"), *extent("_box")).select(F.lit(name).alias("table_name"), kind, "feature_count", "minx", "miny", "maxx", "maxy"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
