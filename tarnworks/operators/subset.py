"""The tables of a river network upstream of an outlet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.ids import typed
from tarnworks.operators.graph import nexus_ids, typed_edges, upstream
from tarnworks.operators.relational import members

#: The key of each table and the ids that it is filtered by.
TABLES = {
    "divides": ("divide_id", "cat"),
    "divide-attributes": ("divide_id", "cat"),
    "flowpaths": ("id", "wb"),
    "flowpath-attributes": ("id", "wb"),
    "flowpath-attributes-ml": ("id", "wb"),
    "hydrolocations": ("id", "wb"),
    "pois": ("id", "wb"),
    "nexus": ("id", "nex"),
    "network": ("id", "wb+nex"),
}


def subset_ids(edges: DataFrame, outlets: DataFrame, with_sibling: bool = True) -> dict[str, DataFrame]:
    """Ids by kind: cat, wb, nex and wb+nex, each one column ``id``."""
    edges = typed_edges(edges)
    selection = upstream(edges, outlets, with_sibling)
    ids = {k: selection.select(typed(k, F.col("node")).alias("id")) for k in ("cat", "wb")}
    ids["nex"] = nexus_ids(edges, selection, outlets)
    return ids | {"wb+nex": ids["wb"].unionByName(ids["nex"])}


def subset_lakes(lakes: DataFrame, pois: DataFrame) -> DataFrame:
    """Lakes at points of interest that are in a subset already."""
    return members(lakes, "poi_id", pois.where(F.col("poi_id").isNotNull()).select("poi_id"))


def subset(tables: dict[str, DataFrame], edges: DataFrame, outlets: DataFrame) -> dict[str, DataFrame]:
    """Every given table's rows upstream of the outlets; empty tables keep their columns."""
    if "lakes" in tables and "pois" not in tables:
        raise ValueError("lakes are found by pois, which are not given")
    ids = subset_ids(edges, outlets)
    out = {name: members(tables[name], key, ids[kind]) for name, (key, kind) in TABLES.items() if name in tables}
    if "lakes" in tables:
        out["lakes"] = subset_lakes(tables["lakes"], out["pois"])
    return out
