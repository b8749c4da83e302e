"""Grids in square tiles with a rim of one cell, so that what looks at a cell's neighbours stays within a task.

Cells at the edges of a tile are copied to the tiles that they touch, about 4 / tile of all cells; the others are shuffled
once. A tile is a dense block of (tile + 2) by (tile + 2) values, whatever the grid's size.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.operators.network import total_drainage
from tarnworks.session import staged

#: Codes of flow directions, as steps in columns and rows (rows run to the south); 0 ends the flow.
D8 = {1: (1, 0), 2: (1, 1), 4: (0, 1), 8: (-1, 1), 16: (-1, 0), 32: (-1, -1), 64: (0, -1), 128: (1, -1)}


def rimmed(cells: DataFrame, tile: int) -> DataFrame:
    """The cells with _tx and _ty, once for each tile that a cell is in or touches."""

    def touched(c: str) -> Column:
        return F.explode(F.array_distinct(F.array(*[F.floor((F.col(c) + d) / tile) for d in (-1, 0, 1)])))

    return cells.withColumn("_tx", touched("col")).withColumn("_ty", touched("row"))


def by_tile(cells: DataFrame, values: list[str], tile: int, kernel: Callable[[pd.DataFrame, int, int], pd.DataFrame], schema: str) -> DataFrame:
    """What ``kernel`` makes of each tile: its cells (col, row, values) with rim, and the column and row of the rim's first corner.

    Of a cell that stands several times, each value is the largest; this is settled before a tile is gathered, so no
    tile holds more than (tile + 2) ** 2 rows. Cells without col or row are left out.
    """

    def whole(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return kernel(frame, int(key[0]) * tile - 1, int(key[1]) * tile - 1)

    # dealt by tile first, so that neither the aggregate nor the grouping moves rows again
    dealt = rimmed(cells.where("col IS NOT NULL AND row IS NOT NULL"), tile).repartition("_tx", "_ty")
    once = dealt.groupBy("_tx", "_ty", "col", "row").agg(*[F.max(v).alias(v) for v in values])
    return once.groupBy("_tx", "_ty").applyInPandas(whole, schema)


def block(frame: pd.DataFrame, value: str, x0: int, y0: int, tile: int, missing, kind) -> np.ndarray:
    """The values by row and column, ``missing`` where there is none."""
    out = np.full((tile + 2, tile + 2), missing, kind)
    there = frame[value].notna().to_numpy()
    out[frame["row"].to_numpy()[there] - y0, frame["col"].to_numpy()[there] - x0] = frame[value].to_numpy()[there].astype(kind)
    return out


def terrain(cells: DataFrame, size: float, tile: int) -> DataFrame:
    """See :func:`tarnworks.operators.raster.terrain`."""

    def kernel(frame: pd.DataFrame, x0: int, y0: int) -> pd.DataFrame:
        z = block(frame, "value", x0, y0, tile, np.nan, float)
        part = {(x, y): z[1 + y : tile + 1 + y, 1 + x : tile + 1 + x] for x in (-1, 0, 1) for y in (-1, 0, 1)}
        e = (part[1, -1] + 2 * part[1, 0] + part[1, 1]) - (part[-1, -1] + 2 * part[-1, 0] + part[-1, 1])
        s = (part[-1, 1] + 2 * part[0, 1] + part[1, 1]) - (part[-1, -1] + 2 * part[0, -1] + part[1, -1])
        row, col = np.nonzero(np.isfinite(e) & np.isfinite(s) & np.isfinite(part[0, 0]))
        east, south = e[row, col] / (8 * size), s[row, col] / (8 * size)
        aspect = pd.Series(np.degrees(np.arctan2(-east, south)) % 360).where((east != 0) | (south != 0))
        return pd.DataFrame({"col": col + x0 + 1, "row": row + y0 + 1, "slope": np.degrees(np.arctan(np.hypot(east, south))), "aspect": aspect})

    kinds = {c: cells.schema[c].dataType.simpleString() for c in ("col", "row")}
    found = by_tile(cells.select("col", "row", F.col("value").cast("double").alias("value")), ["value"], tile, kernel, f"col {kinds['col']}, row {kinds['row']}, slope double, aspect double")
    return found.select("col", "row", "slope", F.nanvl("aspect", F.lit(None).cast("double")).alias("aspect"))


# ---- flow directions


def _number(col, row):
    """One number for a cell; columns and rows are below 2^31."""
    return row * (1 << 32) + (col + (1 << 31))


def _row(number: Column) -> Column:
    return F.shiftright(number, 32)


def _col(number: Column) -> Column:
    return number - _row(number) * (1 << 32) - (1 << 31)


class _Flow:
    """A tile's flow: where its cells go, and what flows together on the way.

    Places are flat indices of the block with its rim. A cell ends where its flow leaves the tile's own cells (``out``, a place on the
    rim with a direction), or at an outlet: a cell whose code is 0 or unknown, or whose next cell is not in the grid.
    """

    def __init__(self, frame: pd.DataFrame, x0: int, y0: int, tile: int):
        self.wide = wide = tile + 2
        code = block(frame, "dir", x0, y0, tile, -1, np.int64).ravel()
        place = np.arange(wide * wide)
        self.own = ((place // wide % (wide - 1) > 0) & (place % wide % (wide - 1) > 0)) & (code >= 0)
        self.cells = np.flatnonzero(self.own)
        target = np.full(len(place), -1)
        inside = (place // wide, place % wide)
        for d, (x, y) in D8.items():
            row, col = inside[0] + y, inside[1] + x
            goes = (code == d) & (row >= 0) & (row < wide) & (col >= 0) & (col < wide)
            target[goes] = (row * wide + col)[goes]
        target[(target >= 0) & (code[np.maximum(target, 0)] < 0)] = -1
        self.target = target
        rim = np.flatnonzero((code >= 0) & ~self.own)
        self.entries = np.unique(target[rim][(target[rim] >= 0) & self.own[np.maximum(target[rim], 0)]])
        # pointers to the last own cell of each flow, doubled until they stand still; what never does is a cycle
        stays = ~self.own | (target < 0) | ~self.own[np.maximum(target, 0)]
        at = np.where(stays, place, target)
        for _ in range(int(math.log2(len(place))) + 1):
            if stays[at].all():
                break
            at = at[at]
        self.end, self.ends = at, stays[at] & self.own
        self.next = np.where(self.ends & ~stays, target, len(place))
        self.col, self.row = inside[1] + x0, inside[0] + y0

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """The weight of each own cell with all that flows through it; weights are whole and their sums below 2^53."""
        total, at = np.append(np.where(self.ends, weight, 0).astype(float), 0.0), np.append(self.next, len(self.next))
        while (at < len(weight)).any():
            total[:-1] += np.bincount(at, weights=total, minlength=len(at))[:-1]
            at = at[at]
        return total[:-1]


def watersheds(cells: DataFrame, tile: int = 256) -> DataFrame:
    """col, row, outlet_col, outlet_row, upstream: the outlet of each cell of a grid of flow directions (col, row, dir), and the number of cells that flow through it, itself included.

    Each tile is solved by itself, and tells only where flow that enters it leaves it again. These entries are a network of about a
    cell in ``tile``, whose outlets and sums are found by pointer doubling; then tiles are solved once more with what enters them.

    Null directions are no data. A cell whose code is 0 or unknown, or that points to no data or out of the grid, is an outlet.
    Cells that lead to no outlet but to a cycle have null for outlet and upstream, and cells beside it are as
    without them. Of a cell that stands several times, the largest code counts. Columns and rows are below 2^31 in size.
    """
    grid = cells.select(F.col("col").cast("bigint").alias("col"), F.col("row").cast("bigint").alias("row"), F.col("dir").cast("bigint").alias("dir")).where("dir IS NOT NULL")

    def entries(frame: pd.DataFrame, x0: int, y0: int) -> pd.DataFrame:
        flow = _Flow(frame, x0, y0, tile)
        number = _number(flow.col, flow.row)
        here = flow.entries[flow.ends[flow.entries]]
        last = flow.end[here]
        leaves = flow.target[last] >= 0
        links = pd.DataFrame({"n": number[here], "to": pd.array(number[flow.target[last]], "Int64"), "outlet": pd.array(number[last], "Int64"), "area": 0})
        links.loc[~leaves, "to"] = pd.NA
        links.loc[leaves, "outlet"] = pd.NA
        out = flow.cells[flow.ends[flow.cells] & (flow.end[flow.cells] == flow.cells) & (flow.target[flow.cells] >= 0)]
        sums = flow.sums(flow.own)
        given = pd.DataFrame({"n": number[flow.target[out]], "to": pd.array([pd.NA] * len(out), "Int64"), "outlet": pd.array([pd.NA] * len(out), "Int64"), "area": sums[out].astype(np.int64)})
        return pd.concat([links, given], ignore_index=True)

    found = by_tile(grid, ["dir"], tile, entries, "n bigint, to bigint, outlet bigint, area bigint")
    links = staged(found.groupBy("n").agg(F.max("to").alias("to"), F.max("outlet").alias("outlet"), F.sum("area").alias("area")), "flow-entries")
    drained = _drained(links)
    cell = [f(F.col(c)).alias(name) for c, prefix in (("n", ""), ("outlet", "outlet_")) for name, f in ((prefix + "col", _col), (prefix + "row", _row))]
    known = drained.select(*cell, F.lit(None).cast("bigint").alias("dir"), "total")

    def solved(frame: pd.DataFrame, x0: int, y0: int) -> pd.DataFrame:
        flow = _Flow(frame, x0, y0, tile)
        outlet_col, outlet_row, has = (block(frame, c, x0, y0, tile, -1, np.int64).ravel() for c in ("outlet_col", "outlet_row", "total"))
        last, target = flow.end[flow.cells], flow.target[flow.end[flow.cells]]
        leaves = target >= 0
        good = flow.ends[flow.cells] & (~leaves | (has[target] >= 0))
        made = {
            "outlet_col": np.where(leaves, outlet_col[target], flow.col[last]),
            "outlet_row": np.where(leaves, outlet_row[target], flow.row[last]),
            "upstream": flow.sums(flow.own + np.maximum(has, 0))[flow.cells].astype(np.int64),
        }
        return pd.DataFrame({"col": flow.col[flow.cells], "row": flow.row[flow.cells]} | {c: pd.Series(v, dtype="Int64").where(good) for c, v in made.items()})

    both = grid.withColumns({c: F.lit(None).cast("bigint") for c in ("outlet_col", "outlet_row", "total")}).unionByName(known)
    return by_tile(both, ["dir", "outlet_col", "outlet_row", "total"], tile, solved, "col bigint, row bigint, outlet_col bigint, outlet_row bigint, upstream bigint")


def _drained(links: DataFrame) -> DataFrame:
    """n, outlet, total: the entries that lead to an outlet, and the area that comes in by each."""
    state, open_ = links.select("n", F.col("to").alias("at"), "outlet"), None
    while True:
        left = state.where("at IS NOT NULL").count()
        # the farthest of the rows that end were met in a round, or all that is left runs in cycles
        if left in (0, open_):
            break
        open_ = left
        ahead = state.select(F.col("n").alias("a_n"), F.col("at").alias("a_at"), F.col("outlet").alias("a_outlet"))
        grown = state.join(ahead, F.col("at") == F.col("a_n"), "left")
        state = staged(grown.select("n", F.when(F.col("at").isNotNull() & F.col("a_n").isNotNull(), F.col("a_at")).alias("at"), F.coalesce("outlet", "a_outlet").alias("outlet")), "flow-outlets")
    ends = staged(state.where("at IS NULL AND outlet IS NOT NULL").select(F.col("n").alias("e_n"), F.col("outlet").alias("e_outlet")), "flow-ends")
    tree = staged(links.join(ends, F.col("n") == F.col("e_n")).select("n", "to", "area", F.col("e_outlet").alias("outlet")), "flow-tree")
    total = total_drainage(tree).select(F.col("n").alias("t_n"), "total")
    return tree.join(total, F.col("n") == F.col("t_n")).select("n", "outlet", "total")
