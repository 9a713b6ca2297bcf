"""DuckDB oracle SQL for the stand-in queries (verification only)."""
