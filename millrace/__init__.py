"""Stream and table operators on PySpark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
