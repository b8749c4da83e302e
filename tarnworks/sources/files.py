"""Text and grid files: sparse corrections, the edge list of a network, ASCII grids, pointer files."""

from __future__ import annotations

import re
from collections.abc import Iterator
from fnmatch import translate
from functools import cache
from urllib.parse import quote, unquote
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.session import dealt, staged

#: Files that a task opens, about; each costs a tenth of a millisecond and more.
FILES = 2_000

#: The columns of the corrections file.
CORRECTIONS = "flowpath_id int, flowpath_toid int, lengthkm double, areasqkm double, totdasqkm double, pathlength double, streamorder int"


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """The corrections with ``ord``, the place of a line in its file; comments may stand anywhere after ``#``."""
    names = [c.split()[0] for c in CORRECTIONS.split(", ")]
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("ord", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", "#.*$", ""))).where((F.col("line") != "") & ~F.col("line").startswith(names[0]))
    return lines.select(F.from_csv("line", CORRECTIONS).alias("c"), F.col("ord").cast("bigint").alias("ord")).select("c.*", "ord")


def _pieces(spark: SparkSession, path: str, end: str | None = None) -> DataFrame:
    """_path, _block, value: the pieces of text files up to each ``end`` (a line break if none), read by byte ranges of many tasks."""
    reader = spark.read.option("lineSep", end) if end else spark.read
    return reader.text(path).select(F.input_file_name().alias("_path"), F.col("_metadata.file_block_start").alias("_block"), "value")


def _placed(pieces: DataFrame) -> DataFrame:
    """The pieces with _pos, the place of each in its file, and _of, the number in its file.

    A byte range is read in order by one task, so numbers given there need only be shifted by what stands in the ranges before; one row a range does.
    """
    numbered = pieces.withColumn("_n", F.monotonically_increasing_id())
    ranges = numbered.groupBy("_path", "_block").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    file = Window.partitionBy("_path")
    before = F.coalesce(F.sum("_rows").over(file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = ranges.select("_path", "_block", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(file).alias("_of"))
    return numbered.join(shifts, ["_path", "_block"]).withColumn("_pos", F.col("_n") + F.col("_shift")).drop("_n", "_shift", "_block")


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """ft, fn, tt, tn and pos (the place in the file) of a network graph in JSON.

    A file is read by many tasks, cut behind closing brackets; an edge is an array of numbers within another array, and the file has no other such arrays.
    Edges too short have nulls, and what is no array is no edge.
    """
    form = r"[\[,]\s*\[([-+.0-9eEnul,\s]*)$"
    edges = _pieces(spark, path, "]").where(F.col("value").rlike(form)).select("_path", "_block", F.split(F.regexp_extract("value", form, 1), ",").alias("e"))
    number = [F.trim(F.get("e", F.lit(k))).try_cast("bigint").alias(c) for k, c in enumerate(("ft", "fn", "tt", "tn"))]
    return _placed(edges).select(*number, F.col("_pos").alias("pos"))


def read_ascii_grid(spark: SparkSession, path: str) -> DataFrame:
    """path, col, row, value of ASCII grids (header lines of a word and a number, then rows from the north); no-data is null.

    Rows count from the south, so that a cell's square is (col, row) times the cell size from the grid's corner. A grid is read by many
    tasks, cut at line breaks; empty lines are no rows.
    """
    lines = _pieces(spark, path).withColumn("value", F.trim(F.regexp_replace("value", r"\s+", " "))).where("value <> ''")
    is_head = F.col("value").rlike("^[A-Za-z]")
    named = lines.where(is_head & (F.lower(F.regexp_extract("value", r"^(\w+)", 1)) == "nodata_value"))
    heads = named.groupBy(F.col("_path").alias("h_path")).agg(F.max(F.regexp_extract("value", r"(\S+)$", 1).try_cast("double")).alias("nodata"))
    rows = _placed(lines.where(~is_head)).join(heads, F.col("_path") == F.col("h_path"), "left")
    cells = rows.select(F.col("_path").alias("path"), "nodata", (F.col("_of") - 1 - F.col("_pos")).alias("row"), F.posexplode(F.split("value", " ")).alias("col", "v"))
    value = F.col("v").try_cast("double")
    return cells.select("path", "col", "row", F.when(~F.coalesce(value == F.col("nodata"), F.lit(False)), value).alias("value"))


@cache
def _local() -> fs.FileSystem:
    return fs.LocalFileSystem()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and its place there."""
    place = re.sub("^file:/+", "/", path)
    return (_local(), place) if place.startswith("/") else fs.FileSystem.from_uri(place)


def _matching(pattern: str) -> re.Pattern:
    """File name patterns as Spark takes them: ``*``, ``?``, ``[..]`` and ``{a,b}``."""
    group = re.search(r"\{([^{}]*)\}", pattern)
    if group is None:
        return re.compile(translate(pattern.replace("[^", "[!")))
    return re.compile("|".join(_matching(pattern[: group.start()] + x + pattern[group.end() :]).pattern for x in group[1].split(",")))


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path of the files below a folder whose names match, as Spark gives them; tasks list the folders, a level at a time."""
    place, matching = opened(folder)[1], _matching(pattern)
    local = folder.startswith(("/", "file:"))
    before = "file://" if local else folder[: folder.rindex(place)]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for folders in batches:
            for path in folders["path"]:
                system, place = opened(unquote(path) if local else path)
                own = [f for f in system.get_file_info(fs.FileSelector(place)) if not re.match(r"\.|_[^=]*$", f.base_name)]
                own = [f for f in own if f.type == fs.FileType.Directory or matching.match(f.base_name)]
                # a path is written as Spark writes it
                named = [before + (re.sub(r'[ "#%<>?\[\\\]^`{|}]', lambda c: quote(c[0]), f.path) if local else f.path) for f in own]
                yield pd.DataFrame({"path": pd.Series(named, dtype=object), "inner": pd.Series([f.type == fs.FileType.Directory for f in own], dtype=bool)})

    level, found = spark.createDataFrame([(quote(f"file://{place}", safe="/:") if local else folder,)], "path string"), []
    while not level.isEmpty():
        found.append(staged(dealt(level, 1, 4 * spark.sparkContext.defaultParallelism).mapInPandas(look, "path string, inner boolean"), "listed"))
        level = found[-1].where("inner").select("path")
    files = found[0]
    for deeper in found[1:]:
        files = files.unionByName(deeper)
    return files.where("NOT inner").select("path")


def read_texts(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, text of the files below a folder whose names match.

    Folders are listed and files are opened by tasks, so neither names nor states of files pass the driver. Only where a file system is open to
    nothing but Spark, its reader takes the files, whose names the driver then holds.
    """
    try:
        opened(folder)
    except (pa.ArrowException, OSError):
        return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for path in batch["path"]:
                system, place = opened(unquote(path) if path.startswith("file:") else path)
                with system.open_input_stream(place) as data:
                    texts.append(data.read().decode(errors="replace"))
            yield pd.DataFrame({"path": batch["path"], "text": pd.Series(texts, index=batch.index, dtype=object)})

    return dealt(_listed(spark, folder, pattern), FILES).mapInPandas(read, "path string, text string")


def write_texts(files: DataFrame) -> DataFrame:
    """Write each text to its path (path, text) where the rows are, and return the paths with their numbers of bytes.

    Nothing is written before the result is used. A file is replaced at once and whole, so a task may run again; null texts are left out.
    A path has one row; of several it is open which one stays. Paths are as Spark gives them (``file:`` ones with escapes).
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        there = ""
        for batch in batches:
            sizes = []
            for path, text in zip(batch["path"], batch["text"]):
                system, place = opened(unquote(path) if path.startswith("file:") else path)
                if place.rpartition("/")[0] != there:
                    there = place.rpartition("/")[0]
                    system.create_dir(there, recursive=True)
                own, data = f"{place}.{uuid4().hex}.part", text.encode()
                with system.open_output_stream(own) as out:
                    out.write(data)
                system.move(own, place)
                sizes.append(len(data))
            yield pd.DataFrame({"path": batch["path"], "bytes": pd.Series(sizes, index=batch.index, dtype="int64")})

    return files.where(F.col("path").isNotNull() & F.col("text").isNotNull()).select("path", "text").mapInPandas(write, "path string, bytes bigint")
