"""Spark-native comparison, balancing and operations analytics over large tables."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
