"""voxloom: a PySpark-native engine for speech-cloning training data."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
