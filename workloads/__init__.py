"""The operators applied to the supplied tables, each beside its SQL twin."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
