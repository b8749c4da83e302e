"""Units along main stems: greedy stretches that are long and large enough.

A stretch begins at the upper end of a stem and ends at the first line at which both its
length and its area are enough; then sums start anew. Where a stretch ends depends on where it
began, so no running sum tells it. But from any line the end of a stretch that began there
is known by itself: sums over 1, 2, 4, ... lines down the stem come by doubling, and the end is found from the
longest to the shortest as in a binary search. Doubling over the lines behind these ends then marks those
at which stretches do begin. All steps are equality joins by line, whatever the length of a stem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.operators.network import _destinations, main_stems
from tarnworks.session import by_key, staged


def _blocks(lines: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ...: b_n, b_next, b_length, b_area of the 2^k lines down a stem from each line that has as many; b_next is the line behind them."""
    block = staged(lines.select(F.col("n").alias("b_n"), F.col("next").alias("b_next"), F.col("length").alias("b_length"), F.col("area").alias("b_area")), "stem-blocks")
    out = [block]
    while True:
        ahead = block.select(*[F.col(c).alias(c.replace("b_", "a_")) for c in block.columns])
        both = block.join(by_key(ahead), F.col("b_next") == F.col("a_n"))
        block = staged(both.select("b_n", F.col("a_next").alias("b_next"), (F.col("b_length") + F.col("a_length")).alias("b_length"), (F.col("b_area") + F.col("a_area")).alias("b_area")), "stem-blocks")
        if block.isEmpty():
            return out
        out.append(block)


def stretch_ends(lines: DataFrame, length: float, area: float) -> DataFrame:
    """n, end, sum_length, sum_area: the line at which a stretch that begins at n has ``length`` and ``area``, or the last one of its stem, and its sums.

    lines: n, next (the next line of the stem), length, area.
    """
    blocks = _blocks(lines)
    state = lines.select("n", F.col("n").alias("at"), F.lit(0.0).alias("sum_length"), F.lit(0.0).alias("sum_area"))
    for block in reversed(blocks):
        ahead = state.join(by_key(block), F.col("at") == F.col("b_n"), "left")
        longer, larger = F.col("sum_length") + F.col("b_length"), F.col("sum_area") + F.col("b_area")
        # past the block, if it is not enough and a line follows
        on = F.coalesce(F.col("b_next").isNotNull() & ((longer < length) | (larger < area)), F.lit(False))
        pick = lambda new, old: F.when(on, new).otherwise(F.col(old)).alias(old)
        state = staged(ahead.select("n", pick(F.col("b_next"), "at"), pick(longer, "sum_length"), pick(larger, "sum_area")), "stem-ends")
    last = lines.select(F.col("n").alias("l_n"), F.col("length").alias("l_length"), F.col("area").alias("l_area"))
    done = state.join(by_key(last), F.col("at") == F.col("l_n"))
    return staged(done.select("n", F.col("at").alias("end"), (F.col("sum_length") + F.col("l_length")).alias("sum_length"), (F.col("sum_area") + F.col("l_area")).alias("sum_area")), "stem-ends")


def _begins(lines: DataFrame, ends: DataFrame) -> DataFrame:
    """n: the lines at which stretches begin, when the first of each stem begins at its top."""
    after = lines.select(F.col("n").alias("t_n"), F.col("next").alias("t_next"))
    jump = ends.join(by_key(after), F.col("end") == F.col("t_n")).select(F.col("n").alias("j_n"), F.col("t_next").alias("j_to")).where("j_to IS NOT NULL")
    jump = staged(jump, "stem-jumps")
    inner = lines.where("next IS NOT NULL").select(F.col("next").alias("i_n"))
    marked = staged(lines.join(by_key(inner), F.col("n") == F.col("i_n"), "left_anti").select("n"), "stem-begins")
    while not jump.isEmpty():
        more = jump.join(by_key(marked), F.col("j_n") == F.col("n"), "left_semi").select(F.col("j_to").alias("n"))
        marked = staged(marked.unionByName(more), "stem-begins")
        ahead = jump.select(F.col("j_n").alias("a_n"), F.col("j_to").alias("a_to"))
        jump = staged(jump.join(by_key(ahead), F.col("j_to") == F.col("a_n")).select("j_n", F.col("a_to").alias("j_to")), "stem-jumps")
    return marked


def placed_along_stems(flowpaths: DataFrame, ideal: float, least_area: float, least_length: float) -> DataFrame:
    """n, to, length, area, stem, at: the line at which the unit of each line (n, to, length, area) ends.

    Stretches have ``ideal`` area and ``least_length``. What is left at the end of a stem is a unit if it has both minima; if not, it joins the unit
    that it flows into, as do tributaries that reach neither. Terminals are always units.
    """
    stems = staged(main_stems(flowpaths).withColumn("area", F.col("area").cast("double")), "stem-units")
    below = stems.select(F.col("n").alias("d_n"), F.col("stem").alias("d_stem"))
    lines = stems.join(by_key(below), F.col("to") == F.col("d_n"), "left").withColumn("next", F.when(F.col("stem") == F.col("d_stem"), F.col("to"))).drop("d_n", "d_stem")
    lines = staged(lines, "stem-units")
    ends = stretch_ends(lines, least_length, ideal)
    begun = ends.join(by_key(_begins(lines, ends).select(F.col("n").alias("g_n"))), F.col("n") == F.col("g_n"), "left_semi")
    enough = (F.col("sum_length") >= least_length) & (F.col("sum_area") >= min(ideal, least_area))
    units = begun.where(enough).select(F.col("end").alias("u_n")).distinct()
    moving = lines.join(by_key(units), F.col("n") == F.col("u_n"), "left").withColumn("moves", F.col("u_n").isNull() & F.col("to").isNotNull())
    at = staged(_destinations(moving.select("n", "to", "moves")), "stem-at").select(F.col("n").alias("o_n"), "at")
    return staged(lines.join(by_key(at), F.col("n") == F.col("o_n")).select("n", "to", "length", "area", "stem", "at"), "stem-placed")


def aggregate_along_stems(flowpaths: DataFrame, ideal: float, least_area: float, least_length: float) -> DataFrame:
    """unit, to_unit, area, length, members: units along main stems, with the length of the stem that they hold."""
    placed = placed_along_stems(flowpaths, ideal, least_area, least_length)
    stem_of = placed.select(F.col("n").alias("z_n"), F.col("stem").alias("z_stem"), F.col("to").alias("z_to"))
    rows = placed.join(by_key(stem_of), F.col("at") == F.col("z_n"))
    sums = rows.groupBy(F.col("at").alias("unit"), "z_to").agg(
        F.sum("area").alias("area"), F.sum(F.when(F.col("stem") == F.col("z_stem"), F.col("length")).otherwise(0.0)).alias("length"), F.count(F.lit(1)).alias("members")
    )
    there = placed.select(F.col("n").alias("t_n"), F.col("at").alias("to_unit"))
    return sums.join(by_key(there), F.col("z_to") == F.col("t_n"), "left").select("unit", "to_unit", "area", "length", "members")
