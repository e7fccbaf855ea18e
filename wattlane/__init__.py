"""Interval-meter analytics as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along: a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
