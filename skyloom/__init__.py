"""Spark-first analytics for gridded, hourly environmental observations."""
