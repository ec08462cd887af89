"""Independent DuckDB statements that state the expected result of every query."""
