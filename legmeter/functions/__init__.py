"""Column expressions: time, geometry, encoded routes, text."""
