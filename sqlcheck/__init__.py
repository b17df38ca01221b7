"""DuckDB oracle SQL for every registered query (independent of the Spark code)."""
