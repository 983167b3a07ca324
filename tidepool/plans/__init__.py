"""Registered query plans (Spark) and their oracle SQL (DuckDB)."""
