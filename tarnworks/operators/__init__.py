"""Operators over DataFrames: relational, aggregate, graph, raster and network steps."""
