"""Governed data products as plain PySpark DataFrame pipelines."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers are sent with the job itself, so
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
