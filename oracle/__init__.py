"""DuckDB statements that compute the registered queries independently of the Spark code."""
