"""Attributes of divides and flowpaths from tables and grids."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.ids import whole
from tarnworks.operators.aggregates import mode_of, weighted_mean
from tarnworks.operators.raster import zonal
from tarnworks.operators.relational import full_join_all, renamed_but


def groundwater(network: DataFrame, basins: DataFrame, digits: int = 9) -> DataFrame:
    """divide_id, mean.Coeff, mean.Zmax (weighted by area, rounded once), mode.Expon (of its floor) over the basins that each divide's references name."""
    walk = network.select(whole(F.col("reference_id")).alias("reference_id"), "divide_id")
    basins = basins.select(whole(F.col("ComID")).alias("ComID"), "Coeff", "Area_sqkm", "Zmax", F.floor("Expon").alias("Expon"))
    joined = basins.join(walk, F.col("ComID") == F.col("reference_id"))
    return joined.groupBy("divide_id").agg(
        weighted_mean(F.col("Coeff"), F.col("Area_sqkm"), digits).alias("mean.Coeff"),
        weighted_mean(F.col("Zmax"), F.col("Area_sqkm"), digits).alias("mean.Zmax"),
        mode_of("Expon").alias("mode.Expon"),
    )


def channels(network: DataFrame, hydraulics: DataFrame, columns: list[str], digits: int = 9) -> DataFrame:
    """flowline_id and the columns' means, weighted by lengthkm and rounded once, over the references of each flowline."""
    walk = network.select("flowline_id", whole(F.col("reference_id")).alias("reference_id"), "lengthkm")
    joined = walk.join(hydraulics.select(F.col("feature_id").alias("_feature"), *columns), F.col("reference_id") == F.col("_feature"))
    return joined.groupBy("flowline_id").agg(*[weighted_mean(F.col(c), F.col("lengthkm"), digits).alias(c) for c in columns])


def soils(covered: DataFrame, plan: dict[str, str], layers: Iterable[int] = (1, 2, 3, 4)) -> DataFrame:
    """divide_id and a column for each name and layer: covered cells (divide_id, name, layer, value, coverage) under the aggregate of their name."""
    tables = []
    for fun in dict.fromkeys(plan.values()):
        names = [n for n, f in plan.items() if f == fun]
        prefix = {"geometric_mean": "geom_mean"}.get(fun, fun)
        wide = zonal(covered.where(F.col("name").isin(*names)), fun, ["divide_id", "name", "layer"], "v")
        columns = [f"{n}_{k}" for n in names for k in layers]
        wide = wide.withColumn("column", F.concat_ws("_", "name", "layer")).groupBy("divide_id").pivot("column", columns)
        tables.append(renamed_but(wide.agg(F.first("v")), "divide_id", lambda c, p=prefix: f"{p}.{c}"))
    return full_join_all(tables, "divide_id")


def minimal_divide_attributes(covered: DataFrame, network: DataFrame, basins: DataFrame) -> DataFrame:
    """divide_id with the majority soil and vegetation class, the mean impervious share, and the groundwater columns.

    covered: divide_id, name (soil, vegetation or impervious), value, coverage.
    """
    plan = {"soil": "mode", "vegetation": "mode", "impervious": "mean"}
    tables = [zonal(covered.where(F.col("name") == n), f, ["divide_id"], f"{f}.{n}") for n, f in plan.items()]
    return reduce(lambda a, b: a.join(b, "divide_id", "full_outer"), [*tables, groundwater(network, basins)])
