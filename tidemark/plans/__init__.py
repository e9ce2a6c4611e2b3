"""Query registry, end-to-end pipeline and the DuckDB oracle twins."""
