"""Registered queries (the driver catalog) and their DuckDB oracle SQL."""
