"""Operators for training-data corpora. Nothing else in the library imports this package.

Functions that run in tasks are sent to executors by value, so executors need no copy
of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
