"""Independent DuckDB spellings of the registered queries, used only for checking."""
