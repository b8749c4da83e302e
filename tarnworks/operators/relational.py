"""Joins and projections of feature and attribute tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, on: dict[str, str] | str) -> DataFrame:
    """Left join in which null keys match null keys; every match makes a row, and the right keys go."""
    pairs = {on: on} if isinstance(on, str) else on
    right = right.withColumnsRenamed({r: f"_key_{r}" for r in pairs.values()})
    clash = {c: f"{c}_right" for c in right.columns if c in left.columns}
    right = right.withColumnsRenamed(clash)
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_key_{r}"]) for k, r in pairs.items()])
    return left.join(right, condition, "left").drop(*[f"_key_{r}" for r in pairs.values()])


def full_join_all(tables: Iterable[DataFrame], key: str) -> DataFrame:
    """Full outer join of any number of tables on one key; null keys do not match."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), tables)


def members(table: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``table`` whose key is among ``ids`` (one column)."""
    ids = ids.select(F.col(ids.columns[0]).alias("_id"))
    return table.join(ids, F.col(key) == F.col("_id"), "left_semi")


def corrected(table: DataFrame, corrections: DataFrame, key: str, order: str) -> DataFrame:
    """Sparse patches: for each key and column the last filled cell by ``order`` wins, on all rows of the key.

    The first column of the corrections is their key. Columns that the table lacks
    are ignored; the table keeps its rows and columns.
    """
    patch_key = corrections.columns[0]
    columns = [c for c in corrections.columns if c in table.columns and c not in (key, order, patch_key)]
    if not columns:
        return table
    last = corrections.groupBy(F.col(patch_key).alias("_key")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_new_{c}") for c in columns]
    )
    joined = table.join(last, F.col(key) == F.col("_key"), "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns])


def renamed_but(table: DataFrame, key: str, name: Callable[[str], str]) -> DataFrame:
    """All columns but the key under the names that ``name`` gives."""
    return table.select(F.col(f"`{key}`"), *[F.col(f"`{c}`").alias(name(c)) for c in table.columns if c != key])


def first_value(table: DataFrame, column: str, order: str) -> DataFrame:
    """One row: the column's value in the first row by ``order``, as text."""
    return table.agg(F.min_by(F.col(column).cast("string"), order).alias(column))


def region_of(table: DataFrame, order: str, name: str = "vpuid", place: int = 5) -> DataFrame:
    """One row, region: the first row's value of the named column, or else of the column at ``place``; null without either."""
    column = name if name in table.columns else (table.columns[place] if len(table.columns) > place else None)
    if column is None:
        return table.agg(F.max(F.lit(None).cast("string")).alias("region"))
    return table.agg(F.min_by(F.col(f"`{column}`").cast("string"), order).alias("region"))
