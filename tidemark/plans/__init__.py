"""Registered queries (Spark) with their DuckDB oracle SQL, and batch jobs."""
