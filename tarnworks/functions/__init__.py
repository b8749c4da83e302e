"""Column-returning functions: typed ids, geometry codecs, projection, display expressions."""
