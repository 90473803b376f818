"""Data work of staged post-training as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
