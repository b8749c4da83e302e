"""Steps that turn a reference river network into a model-ready one.

Flowpaths are rows with an id and the id of the one they flow into (null at a
terminal). Steps that follow flow lines use pointer doubling: in round k a row
knows its 2^k-th downstream neighbour, so a network of depth d takes log2(d)
rounds, each a join of the table with itself, and each written. In a table of n
rows no way is longer than n, so what still moves after log2(n) rounds goes
around a cycle: a cycle ends on its smallest row, which counts as a terminal. A target that is
not in the table, as at the edge of a region, makes a terminal too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.geometry import cut_line
from tarnworks.functions.ids import typed, with_prefix
from tarnworks.operators.relational import left_join
from tarnworks.session import by_key, staged


def with_network_attributes(divides: DataFrame, network: DataFrame) -> DataFrame:
    """Divides with length and total drainage area; several values for a divide make several rows."""
    attributes = network.select("divide_id", F.col("flowpath_lengthkm").alias("lengthkm"), "tot_drainage_areasqkm").distinct()
    return left_join(divides, attributes, "divide_id")


def reconciled_divides(divides: DataFrame, flowpaths: DataFrame, vpuid: str) -> DataFrame:
    """toid is the flowpath's as it stands; a flowpath that is there twice doubles the divide."""
    joined = left_join(divides, flowpaths.select("flowpath_id", F.col("flowpath_toid").alias("toid")), "flowpath_id")
    return joined.withColumn("id", with_prefix(F.col("flowpath_id"), "fp", "wb")).drop("flowpath_id").withColumn("vpuid", F.lit(vpuid))


def reconciled_flowpaths(flowpaths: DataFrame, vpuid: str) -> DataFrame:
    new = {"id": with_prefix(F.col("flowpath_id"), "fp", "wb"), "toid": F.col("flowpath_toid"), "vpuid": F.lit(vpuid)}
    return flowpaths.withColumns(new).drop("flowpath_id", "flowpath_toid", "flowline_id", "member_comid")


def reconciled_nexus(nexus: DataFrame, network: DataFrame, vpuid: str) -> DataFrame:
    """Nexus with the point of interest of the flowpath of its number; two points make two rows."""
    pois = network.select("flowpath_id", "poi_id").distinct().where(F.col("poi_id").isNotNull())
    pois = pois.select(with_prefix(F.col("flowpath_id"), "fp", "nex").alias("nexus_id"), "poi_id")
    renamed = nexus.withColumns({"id": F.col("nexus_id"), "toid": with_prefix(F.col("nexus_toid"), "fp", "wb")}).drop("nexus_id", "nexus_toid")
    return left_join(renamed, pois, {"id": "nexus_id"}).withColumns({"type": F.lit("nexus"), "vpuid": F.lit(vpuid)})


def nexus_topology(flowpaths: DataFrame) -> DataFrame:
    """id, toid: each flowpath n that flows into t as wb-n -> nex-t, and each nexus as nex-t -> wb-t."""
    into = flowpaths.where(F.col("to").isNotNull())
    return into.select(typed("wb", F.col("n")).alias("id"), typed("nex", F.col("to")).alias("toid")).union(
        into.select(typed("nex", F.col("to")).alias("id"), typed("wb", F.col("to")).alias("toid")).distinct()
    )


def split_long_lines(flowpaths: DataFrame, most: float) -> DataFrame:
    """n, part, parts, length, to, to_part: lines longer than ``most`` in equal parts, numbered downstream from 1.

    With a column ``geom`` each part has its stretch of the line, cut at equal lengths along its vertices.
    """
    shaped = "geom" in flowpaths.columns
    parts = F.greatest(F.ceil(F.col("length") / most), F.lit(1)).cast("bigint")
    rows = flowpaths.select("n", "to", "length", parts.alias("parts"), *(["geom"] if shaped else []))
    if shaped:
        rows = rows.select("n", "to", "length", "parts", F.posexplode(cut_line("geom", "parts")).alias("part", "geom")).withColumn("part", F.col("part").cast("bigint") + 1)
    else:
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("parts"))))
    last = F.col("part") == F.col("parts")
    to = F.when(last, F.col("to")).otherwise(F.col("n"))
    to_part = F.when(~last, F.col("part") + 1).when(F.col("to").isNotNull(), F.lit(1))
    more = ["geom"] if shaped else []
    return rows.select("n", "part", "parts", (F.col("length") / F.col("parts")).alias("length"), to.alias("to"), to_part.cast("bigint").alias("to_part"), *more)


def _within(flowpaths: DataFrame) -> DataFrame:
    """The rows with ``to`` null where it names no row."""
    there = flowpaths.select(F.col("n").alias("w_n"))
    return flowpaths.join(by_key(there), F.col("to") == F.col("w_n"), "left").withColumn("to", F.col("w_n")).drop("w_n")


def _rounds(state: DataFrame) -> range:
    return range(state.count().bit_length() + 1)


def _destinations(table: DataFrame) -> DataFrame:
    """n, at: where a row ends up that moves on along ``to`` while ``moves`` holds. Cycles of moving rows end on their smallest n.

    ``low`` is the smallest row passed on the way to ``at``, ``rest`` says that ``at``
    does not move. After all rounds, what a row of a cycle has passed is its whole cycle.
    """
    rest = ~F.col("moves") | F.col("to").isNull()
    state = staged(table.select("n", F.when(rest, F.col("n")).otherwise(F.col("to")).alias("at"), F.col("n").alias("low"), rest.alias("rest")), "destinations")
    for _ in _rounds(state):
        if state.where(~F.col("rest")).isEmpty():
            return state.select("n", "at")
        ahead = state.select(F.col("n").alias("a_n"), F.col("at").alias("a_at"), F.col("low").alias("a_low"), F.col("rest").alias("a_rest"))
        on = state.join(by_key(ahead), F.col("at") == F.col("a_n"))
        state = staged(on.select("n", F.col("a_at").alias("at"), F.least("low", "a_low").alias("low"), F.col("a_rest").alias("rest")), "destinations")
    ends = state.select(F.col("n").alias("e_n"), F.when(F.col("rest"), F.col("at")).otherwise(F.col("low")).alias("e_at"))
    return staged(state.join(by_key(ends), F.col("at") == F.col("e_n")).select("n", F.col("e_at").alias("at")), "destinations")


def _without_cycles(flowpaths: DataFrame) -> DataFrame:
    """Each cycle is cut behind its smallest row."""
    at = _destinations(flowpaths.withColumn("moves", F.lit(True)))
    ends = at.where(F.col("n") == F.col("at")).select(F.col("n").alias("c_n"))
    cut = flowpaths.join(by_key(ends), F.col("n") == F.col("c_n"), "left")
    return cut.withColumn("to", F.when(F.col("c_n").isNull(), F.col("to"))).drop("c_n")


def collapse_short_lines(flowpaths: DataFrame, least: float, least_main: float | None = None) -> DataFrame:
    """n, to, length, area, members: lines shorter than ``least`` join the first line downstream that is not.

    With ``least_main`` that length holds for lines of a main stem instead: those that bring the most drainage of all inflows
    of the next line. A short terminal stays. Lengths are of the lines that stay, areas are sums.
    """
    flowpaths = staged(_within(flowpaths), "collapse-lines")
    short = F.col("length") < least
    table = flowpaths
    if least_main is not None:
        main = main_inflows(total_drainage(flowpaths)).select(F.col("main").alias("m_n"))
        table = flowpaths.join(by_key(main), F.col("n") == F.col("m_n"), "left")
        short = F.when(F.col("m_n").isNull(), short).otherwise(F.col("length") < least_main)
    at = _destinations(table.withColumn("moves", short))
    to_at = at.select(F.col("n").alias("t_n"), F.col("at").alias("t_at"))
    own = flowpaths.join(by_key(at.withColumnRenamed("n", "d_n")), F.col("n") == F.col("d_n"))
    sums = own.groupBy(F.col("at").alias("s_n")).agg(F.sum("area").alias("s_area"), F.count(F.lit(1)).alias("members"))
    stay = flowpaths.join(by_key(sums), F.col("n") == F.col("s_n")).join(by_key(to_at), F.col("to") == F.col("t_n"), "left")
    return stay.select("n", F.nullif("t_at", "n").alias("to"), "length", F.col("s_area").alias("area"), "members")


def total_drainage(flowpaths: DataFrame) -> DataFrame:
    """n, to, area, total: the area of a line and of everything that flows into it."""
    flowpaths = staged(_within(flowpaths).select("n", "to", "area"), "drainage-lines")
    state = flowpaths.select("n", F.col("to").alias("far"), F.col("area").alias("total"))
    for _ in _rounds(state):
        if state.where("far IS NOT NULL").isEmpty():
            return flowpaths.join(by_key(state.select(F.col("n").alias("t_n"), "total")), F.col("n") == F.col("t_n")).drop("t_n")
        into = state.where("far IS NOT NULL").groupBy(F.col("far").alias("i_n")).agg(F.sum("total").alias("more"))
        ahead = state.select(F.col("n").alias("a_n"), F.col("far").alias("a_far"))
        grown = state.join(by_key(into), F.col("n") == F.col("i_n"), "left").join(by_key(ahead), F.col("far") == F.col("a_n"), "left")
        state = staged(grown.select("n", F.col("a_far").alias("far"), (F.col("total") + F.coalesce("more", F.lit(0))).alias("total")), "drainage")
    return total_drainage(_without_cycles(flowpaths))


def main_inflows(drained: DataFrame) -> DataFrame:
    """line, main: of the lines that flow into a line, the one with the largest total drainage, then the smallest n."""
    largest = F.max(F.struct("total", (-F.col("n")).alias("back"))).alias("top")
    return drained.where("to IS NOT NULL").groupBy(F.col("to").alias("line")).agg(largest).select("line", (-F.col("top.back")).alias("main"))


def main_stems(flowpaths: DataFrame) -> DataFrame:
    """n, to, length, area, stem, place, reach: the main stem of each line (n, to, length, area).

    Heavy paths: at a confluence the inflow of the largest total drainage goes on, so every line is in one stem, whose
    number is its last line's. ``place`` counts the lines from there up, from 1, and ``reach`` is the length from
    the line's upper end to the end of the stem. Cycles are cut behind their smallest line.
    """
    drained = staged(total_drainage(flowpaths), "stem-drained")
    lines = drained.join(by_key(flowpaths.select(F.col("n").alias("f_n"), "length")), F.col("n") == F.col("f_n")).drop("f_n")
    main = main_inflows(drained).select(F.col("main").alias("m_n"))
    lines = staged(lines.join(by_key(main), F.col("n") == F.col("m_n"), "left").withColumn("on", F.col("m_n").isNotNull()).drop("m_n"), "stem-lines")
    state = lines.select("n", F.when(F.col("on"), F.col("to")).otherwise(F.col("n")).alias("at"), F.col("on").alias("open"), F.col("on").cast("bigint").alias("steps"), F.when(F.col("on"), F.col("length")).otherwise(0.0).alias("passed"))
    state = staged(state, "stem")
    while not state.where("open").isEmpty():
        ahead = state.select(*[F.col(c).alias(f"a_{c}") for c in state.columns])
        grown = state.join(by_key(ahead), F.col("at") == F.col("a_n"))
        state = staged(grown.select("n", F.col("a_at").alias("at"), F.col("a_open").alias("open"), (F.col("steps") + F.col("a_steps")).alias("steps"), (F.col("passed") + F.col("a_passed")).alias("passed")), "stem")
    ends = lines.select(F.col("n").alias("e_n"), F.col("length").alias("e_length"))
    found = state.join(by_key(ends), F.col("at") == F.col("e_n")).select(F.col("n").alias("s_n"), F.col("at").alias("stem"), (F.col("steps") + 1).alias("place"), (F.col("passed") + F.col("e_length")).alias("reach"))
    return lines.join(by_key(found), F.col("n") == F.col("s_n")).select("n", "to", "length", "area", "stem", "place", "reach")


def aggregate_to_size(flowpaths: DataFrame, ideal: float, least: float) -> DataFrame:
    """unit, to_unit, area, members: lines grouped to units of about ``ideal`` area along the flow.

    A line ends a unit where its total drainage passes a multiple of ``ideal`` that
    the drainage at no inflow has passed, and at terminals. Units smaller than
    ``least`` join the one downstream.
    """
    drained = staged(total_drainage(flowpaths), "aggregate-drained")
    step = F.floor(F.col("total") / ideal)
    inflow = drained.where("to IS NOT NULL").groupBy(F.col("to").alias("i_n")).agg(F.max(step).alias("passed"))
    ends = drained.join(by_key(inflow), F.col("n") == F.col("i_n"), "left").withColumn("moves", (step <= F.coalesce("passed", F.lit(0))) & F.col("to").isNotNull())
    at = staged(_destinations(ends.select("n", "to", "moves")), "aggregate-at")
    units = _contracted(drained.select("n", "to", "area", F.lit(1).cast("bigint").alias("members")), at)
    small = units.withColumn("moves", (F.col("area") < least) & F.col("to").isNotNull())
    merged = _contracted(units, staged(_destinations(small.select("n", "to", "moves")), "aggregate-merged"))
    return merged.select(F.col("n").alias("unit"), F.col("to").alias("to_unit"), "area", "members")


def _contracted(table: DataFrame, at: DataFrame) -> DataFrame:
    """Rows joined into those they ended up at: n, to (where that row's outflow ended up), area, members."""
    own, there = at.select(F.col("n").alias("o_n"), F.col("at").alias("o_at")), at.select(F.col("n").alias("t_n"), F.col("at").alias("t_at"))
    sums = table.join(by_key(own), F.col("n") == F.col("o_n")).groupBy("o_at").agg(F.sum("area").alias("s_area"), F.sum("members").alias("s_members"))
    out = table.select("n", "to").join(by_key(sums), F.col("n") == F.col("o_at")).join(by_key(there), F.col("to") == F.col("t_n"), "left")
    return staged(out.select("n", F.nullif("t_at", "n").alias("to"), F.col("s_area").alias("area"), F.col("s_members").alias("members")), "contracted")


def placed_at_outlets(flowpaths: DataFrame, outlets: DataFrame) -> DataFrame:
    """n, at: the first of the given outlets, or the terminal, downstream of each line."""
    flowpaths = _within(flowpaths)
    marks = outlets.select(F.col(outlets.columns[0]).alias("m_n"), F.lit(True).alias("mark")).distinct()
    moving = flowpaths.join(by_key(marks), F.col("n") == F.col("m_n"), "left").withColumn("moves", F.col("mark").isNull() & F.col("to").isNotNull())
    return staged(_destinations(moving.select("n", "to", "moves")), "outlets-at")


def aggregate_to_outlets(flowpaths: DataFrame, outlets: DataFrame) -> DataFrame:
    """unit, to_unit, area, members: every line joins the outlet or terminal that it is placed at."""
    lines = _within(flowpaths).select("n", "to", "area", F.lit(1).cast("bigint").alias("members"))
    out = _contracted(lines, placed_at_outlets(flowpaths, outlets))
    return out.select(F.col("n").alias("unit"), F.col("to").alias("to_unit"), "area", "members")


def model_network(flowlines: DataFrame, units: DataFrame, placed: DataFrame) -> DataFrame:
    """The crosswalk of a model network: reference_id, flowpath_id, divide_id, flowpath_toid, areasqkm.

    flowlines: n, area; placed: n, at (the unit of each line); units: unit, to_unit.
    """
    rows = flowlines.join(placed.select(F.col("n").alias("p_n"), "at"), F.col("n") == F.col("p_n")).join(units.select("unit", "to_unit"), F.col("at") == F.col("unit"))
    return rows.select(F.col("n").cast("string").alias("reference_id"), typed("fp", F.col("unit")).alias("flowpath_id"), typed("cat", F.col("unit")).alias("divide_id"), typed("fp", F.col("to_unit")).alias("flowpath_toid"), F.col("area").alias("areasqkm"))
