"""Column-level functions: text repair, numeric shaping, ordered series."""
