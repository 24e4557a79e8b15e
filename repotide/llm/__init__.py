"""Operators of a training-data pipeline over whole document tables.

Functions of this package travel to the executors by value, so that workers need numpy,
pyarrow and the other libraries, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
