"""Partitioned, offset-ordered event logs as Spark DataFrames and streaming jobs."""
