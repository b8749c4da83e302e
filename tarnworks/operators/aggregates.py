"""Aggregates that respect missing values and ties; each is a column for ``groupBy().agg()``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_mean(value: Column, weight: Column, digits: int = 9) -> Column:
    """Mean over rows with a value. A missing weight beside a value makes it null, as do weights that sum to 0."""
    there = value.isNotNull()
    total = F.sum(F.when(there, weight.cast("double")))
    mean = F.try_divide(F.sum(F.when(there, value * weight).cast("double")), total)
    return F.when(F.count_if(there & weight.isNull()) == 0, F.round(mean, digits))


def mode_of(column: str) -> Column:
    """The most frequent value of a column, of ties the largest; missing values do not count."""
    return F.expr(f"mode() WITHIN GROUP (ORDER BY {column} DESC)")


def weighted_mode(table: DataFrame, keys: list[str], value: str, weight: str, name: str) -> DataFrame:
    """For each key the value with the largest total weight, of ties the largest value; null values do not count."""
    totals = table.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("_weight"))
    return totals.groupBy(*keys).agg(F.max_by(value, F.struct("_weight", value)).alias(name))


def zonal_mean(value: Column, coverage: Column) -> Column:
    there = value.isNotNull()
    return F.try_divide(F.sum(F.when(there, value * coverage).cast("double")), F.sum(F.when(there, coverage).cast("double")))


def geometric_mean(value: Column, coverage: Column) -> Column:
    """Over positive values, weighted by coverage."""
    there = value > 0
    return F.exp(F.try_divide(F.sum(F.when(there, F.log(F.when(there, value)) * coverage)), F.sum(F.when(there, coverage.cast("double")))))


def circular_mean(degrees: Column, coverage: Column) -> Column:
    """Mean direction in [0, 360)."""
    angle = F.radians(degrees)
    return F.pmod(F.degrees(F.atan2(F.sum(coverage * F.sin(angle)), F.sum(coverage * F.cos(angle)))), F.lit(360.0))


ZONAL = {"mean": zonal_mean, "geometric_mean": geometric_mean, "circular_mean": circular_mean}


def extent(box: str) -> list[Column]:
    """The union of boxes in a struct column; missing boxes do not count."""
    return [F.min(f"{box}.minx").alias("minx"), F.min(f"{box}.miny").alias("miny"), F.max(f"{box}.maxx").alias("maxx"), F.max(f"{box}.maxy").alias("maxy")]
