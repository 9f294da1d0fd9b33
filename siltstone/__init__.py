"""Siltstone: layered tables, named quality rules and change feeds on Spark.

Every operator takes and returns DataFrames.  The plan is always built from
Spark's own columns, joins and aggregates, so Catalyst sees all of it.
"""

__version__ = "0.1.0"
