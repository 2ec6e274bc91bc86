"""Spark jobs for dated records with a numeric target.

Ingest, clean, accumulate, train, compare, monitor and score; see README.md.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from aerolake.config import FlightConfig

# Task functions travel with their code, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

__all__ = ["FlightConfig"]
