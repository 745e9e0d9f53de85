"""Column-level helpers: missing values, arithmetic, recodes, fixed reference values."""
