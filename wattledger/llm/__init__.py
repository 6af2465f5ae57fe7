"""Operators of a training-data pipeline: deduplication, filters, scoring, scans and mixing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that these need no copy of
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
