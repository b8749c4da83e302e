"""From a reference network to a model-ready one: the steps in order, each a function of layers.

A step takes a mapping of layer names to DataFrames and gives the layers that it
changes; the others are carried over. Nothing runs until a layer is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.geometry import centroid, simple_line
from tarnworks.operators import attributes, dissolve, network, raster, stems
from tarnworks.operators.relational import corrected, left_join
from tarnworks.session import by_key

Layers = dict[str, DataFrame]


@dataclass(frozen=True)
class Settings:
    """Lengths in metres, areas in square kilometres."""

    vpuid: str = "16"
    split: float = 10000.0
    collapse: float = 1000.0
    collapse_main: float = 1000.0
    simplify: float = 400.0
    ideal_area: float = 5.0
    least_length_km: float = 0.5
    least_area: float = 1.0


def prepare(layers: Layers, settings: Settings) -> Layers:
    """Every layer with its processing region."""
    return {n: t.withColumn("vpuid", F.lit(settings.vpuid)) for n, t in layers.items()}


def correct(layers: Layers, corrections: DataFrame) -> Layers:
    """The same corrections on flowpaths and network."""
    return layers | {n: corrected(layers[n], corrections, "flowpath_id", "ord") for n in ("flowpaths", "network")}


def refactor(layers: Layers, settings: Settings) -> Layers:
    """Lines (n, to, length in metres, area) without short ones; ``parts`` has the long ones split, with their stretch of ``geom``, simplified, if lines have one."""
    main = settings.collapse_main if settings.collapse_main != settings.collapse else None
    lines = network.collapse_short_lines(layers["lines"], settings.collapse, main)
    if "geom" in layers["lines"].columns:
        shapes = layers["lines"].select(F.col("n").alias("g_n"), "geom")
        lines = lines.join(shapes, F.col("n") == F.col("g_n")).drop("g_n")
    parts = network.split_long_lines(lines, settings.split)
    if "geom" in parts.columns and settings.simplify:
        parts = parts.withColumn("geom", simple_line(F.col("geom"), settings.simplify))
    return layers | {"lines": lines, "parts": parts}


def aggregate(layers: Layers, settings: Settings) -> Layers:
    return layers | {"units": network.aggregate_to_size(layers["lines"], settings.ideal_area, settings.least_area)}


def distribute(layers: Layers, settings: Settings) -> Layers:
    """Units of even size along main stems; ``line-divides`` (n, geom), if there, are merged to ``unit-divides`` (unit, geom)."""
    lines, least = layers["lines"], settings.least_length_km * 1000
    out = layers | {"units": stems.aggregate_along_stems(lines, settings.ideal_area, settings.least_area, least)}
    if "line-divides" in layers:
        placed = stems.placed_along_stems(lines, settings.ideal_area, settings.least_area, least)
        out["unit-divides"] = dissolve.merged_divides(layers["line-divides"], placed)
    return out


def describe(layers: Layers) -> Layers:
    """Divides with the network's attributes."""
    return layers | {"divides": network.with_network_attributes(layers["divides"], layers["network"])}


def add_minimal_attributes(layers: Layers, covered: DataFrame, basins: DataFrame, hydraulics: DataFrame, columns: list[str]) -> Layers:
    return layers | {
        "divide-attributes": attributes.minimal_divide_attributes(covered, layers["network"], basins),
        "flowpath-attributes": attributes.channels(layers["network"], hydraulics, columns),
    }


def add_value_attributes(layers: Layers, more: DataFrame) -> Layers:
    """Divide attributes with further columns; a leaf, as reconciling goes on from the minimal attributes."""
    return layers | {"divide-attributes": left_join(layers["divide-attributes"], by_key(more), "divide_id")}


def add_zonal_attributes(layers: Layers, divides: DataFrame, cells: DataFrame, columns: dict[str, str], size: float = 1.0, tile: int = 64) -> Layers:
    """Divide attributes with aggregates of the cells (col, row, value) under each divide, by name and function, and its centroid x, y."""
    covered = raster.overlay(divides.select("divide_id", "geom"), cells, size, tile)
    for name, fun in columns.items():
        layers = add_value_attributes(layers, raster.zonal(covered, fun, ["divide_id"], name))
    return add_value_attributes(layers, divides.select("divide_id", centroid("geom").alias("_at")).select("divide_id", "_at.*"))


def reconcile(layers: Layers, settings: Settings) -> Layers:
    return layers | {
        "divides": network.reconciled_divides(layers["divides"], layers["flowpaths"], settings.vpuid),
        "flowpaths": network.reconciled_flowpaths(layers["flowpaths"], settings.vpuid),
        "nexus": network.reconciled_nexus(layers["nexus"], layers["network"], settings.vpuid),
    }
