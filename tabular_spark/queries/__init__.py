"""Queries over the given tables, each with its SQL."""

from tabular_spark.queries import cleaning, files, modelling, profiling, running, splitting  # noqa: F401
from tabular_spark.queries.registry import ORACLES, QUERIES  # noqa: F401
