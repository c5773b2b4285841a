"""DuckDB oracle SQL for every registered query (independent formulations)."""
