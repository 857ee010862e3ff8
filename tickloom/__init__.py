"""tickloom: Spark-native market and sentiment analytics.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``) keyed by ``(symbol, date)``; rolling, lagged and cumulative
computations are windows partitioned by symbol and ordered by date.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions that run in Spark's Python workers travel by value: executors need
# not have the package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
