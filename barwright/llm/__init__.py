"""Operators of a large-scale training-data pipeline. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a job needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
