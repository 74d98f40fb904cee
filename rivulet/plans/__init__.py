"""Named queries (with DuckDB oracles) over the test tables."""
