"""Operators for preparing training text. Their functions travel to Spark's Python workers by value."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
