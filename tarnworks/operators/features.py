"""Rows as GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.functions.geometry import geojson


def properties(table: DataFrame, geom: str, names: list[str] | None = None) -> list[Column]:
    """The named columns, or all but the geometry; binary ones are null."""
    kept = [f for f in table.schema if f.name != geom and (names is None or f.name in names)]
    return [F.lit(None).cast("string").alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f"`{f.name}`") for f in kept]


def features(table: DataFrame, geom: str = "geom", keep: list[str] | None = None, project: bool = True, names: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, feature (text) and box; a row whose geometry is missing or cannot be decoded goes.

    Properties are the columns ``names``, or all. Missing ones are written as null. With only a geometry, the properties are empty.
    """
    said = properties(table, geom, names)
    text = F.to_json(F.struct(*said), {"ignoreNullFields": "false"}) if said else F.lit("{}")
    shaped = table.select(*[F.col(f"`{c}`") for c in keep or []], geojson(F.col(f"`{geom}`"), project).alias("_shape"), text.alias("_said")).where("_shape.json IS NOT NULL")
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), F.col("_shape.json"), F.lit(',"properties":'), F.col("_said"), F.lit("}"))
    return shaped.select(*(keep or []), feature.alias("feature"), F.col("_shape").dropFields("json").alias("box"))


def collections(made: DataFrame, by: str, order: str) -> DataFrame:
    """A FeatureCollection with its box for each value of ``by``: an export for display, whose features are few."""
    lists = made.groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct(order, "feature"))).alias("_found"),
        *[getattr(F, side)(f"box.{c}").alias(c) for c, side in (("minx", "min"), ("miny", "min"), ("maxx", "max"), ("maxy", "max"))],
    )
    joined = F.array_join(F.transform("_found", lambda x: x["feature"]), ",")
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}"))
    return lists.select(by, text.alias("collection"), "minx", "miny", "maxx", "maxy")


def write_features(made: DataFrame, path: str) -> None:
    """One feature a line, in parts, for any number of features."""
    made.select("feature").write.mode("overwrite").text(path)
