"""Operators for large text corpora. Nothing else in the library imports this package.

Functions of this package travel to the executors by value, so that the workers need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
