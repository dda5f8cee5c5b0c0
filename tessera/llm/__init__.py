"""Training-data operators; nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their tasks, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
