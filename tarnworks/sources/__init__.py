"""Reading and writing: layer folders, GeoPackage containers, grids, graphs, corrections."""
