"""A Spark-native record linkage engine.

Functions that run on executors are sent by value, so that executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
