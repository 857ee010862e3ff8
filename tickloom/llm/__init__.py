"""Operators for large-scale training data: one module per operator.

Functions of this package run inside Spark's Python workers.  They are pickled
by value, so executors do not need the package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
