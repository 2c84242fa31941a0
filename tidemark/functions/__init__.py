"""Column -> Column building blocks (scalar and per-series window functions)."""
