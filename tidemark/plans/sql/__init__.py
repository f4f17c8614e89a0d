"""DuckDB oracle SQL for the registered queries (checked side by side)."""
