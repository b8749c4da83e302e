"""Pointer files: small texts that name a tracked object by path, size and checksum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# fixed values: the lines of the pointer format
_OUTS = "^outs:"
_FROZEN = r"^\s*frozen:\s*true\s*$"
_CONTENT = r"^\s*(md5|size):"


def _lines(text: Column, removed: bool) -> Column:
    lines = F.split(text, "\n", -1)
    outs = F.array_position(F.transform(lines, lambda x: x.rlike(_OUTS)), F.lit(True))

    def goes(line: Column, place: Column) -> Column:
        after = (outs > 0) & (place >= outs)
        return line.rlike(_FROZEN) | (after & line.rlike(_CONTENT))

    return F.filter(lines, goes if removed else lambda line, place: ~goes(line, place))


def cleaned(text: Column) -> Column:
    """The text without ``frozen: true`` lines, and without ``md5:`` and ``size:`` lines after the first line ``outs:``."""
    return F.array_join(_lines(text, False), "\n")


def removed(text: Column) -> Column:
    """The lines that :func:`cleaned` leaves out, without blanks at their ends."""
    return F.transform(_lines(text, True), lambda x: F.regexp_replace(x, r"\s+$", ""))


def rewritten(files: DataFrame) -> DataFrame:
    """path, text, removed: the files that cleaning changes, with their new texts; others and null texts are left out."""
    found = files.select("path", cleaned(F.col("text")).alias("text"), removed(F.col("text")).alias("removed"))
    return found.where(F.size("removed") > 0)


def tallies(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """folder, modified, unchanged: what :func:`cleaned` would change; nothing is written."""
    folder = F.regexp_replace(F.col(path), "/[^/]*$", "")
    changed = cleaned(F.col(text)) != F.col(text)
    return files.groupBy(folder.alias("folder")).agg(F.count_if(changed).alias("modified"), F.count_if(~changed).alias("unchanged"))


def tracked(pointers: DataFrame) -> DataFrame:
    """path, md5, size from the texts of pointers."""
    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("text", rf"(?m)^\s*-?\s*{name}:\s*(\S+)\s*$", 1), F.lit(""))

    return pointers.select(field("path").alias("path"), field("md5").alias("md5"), field("size").try_cast("bigint").alias("size"))


def present(pointers: DataFrame, listing: DataFrame) -> DataFrame:
    """The tracked objects with there: whether the listing (path, size) has them, with the size where a pointer names one."""
    sizes = listing.groupBy(F.col("path").alias("_path")).agg(F.collect_set("size").alias("_sizes"))  # a path has few sizes
    met = tracked(pointers).join(sizes, F.col("path") == F.col("_path"), "left")
    there = F.col("_path").isNotNull() & (F.col("size").isNull() | F.array_contains("_sizes", F.col("size")))
    return met.select("path", "md5", "size", F.coalesce(there, F.lit(False)).alias("there"))
