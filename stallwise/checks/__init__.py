"""Independent SQL twins of the named queries, for DuckDB."""
