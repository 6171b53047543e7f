"""Tabular analytics and regression as plain Spark DataFrame jobs."""
