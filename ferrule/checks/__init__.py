"""Correctness checks: DuckDB oracle SQL for every registered query and a local compare harness."""
