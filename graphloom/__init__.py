"""graphloom: a PySpark-native engine that turns document collections into a queryable property graph."""

import sys

from pyspark import cloudpickle

# Executors may not have this repository on their path: ship the package's functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
