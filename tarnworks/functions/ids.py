"""Typed ids ``<prefix>-<number>``: cat- (divide), wb- and fp- (flowpath), nex- (nexus) share the number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def typed(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), number.cast("string"))


def number_of(typed_id: Column) -> Column:
    """The number of an id; null where there is none."""
    return F.split_part(typed_id, F.lit("-"), F.lit(2)).try_cast("bigint")


def with_prefix(typed_id: Column, old: str, new: str) -> Column:
    """The id under another prefix; ids of other kinds stay as they are."""
    return F.regexp_replace(typed_id, f"^{old}-", f"{new}-")


def whole(value: Column) -> Column:
    """Truncated to an int; null where the text is no number."""
    return value.cast("string").try_cast("double").try_cast("int")
