"""ferrule: PySpark operators and batch jobs for loan-servicing, HR and climate analytics.

Subpackages
-----------
functions  Column-level helpers (date arithmetic, text rules, row-wise aggregates, rule tables).
operators  DataFrame-level operators (history/snapshots, statistics, data-quality checks).
sources    Readers, writers, schemas and the adapter that maps the driver tables onto job roles.
plans      The six jobs, each a function from DataFrames and parameters to DataFrames.
"""

__all__ = ["functions", "operators", "sources", "plans"]
