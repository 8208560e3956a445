"""Operators for training data: search, deduplication, quality, mixing, sharding and files.

Functions that run in tasks are shipped by value, so workers need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
