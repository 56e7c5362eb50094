"""SQL twins of the registered queries, for checking results with DuckDB."""
