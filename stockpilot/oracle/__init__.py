"""DuckDB specification of every registered query, used as the test oracle."""
