"""Batch operators, DataFrame -> DataFrame. The few that run Python in tasks travel by value."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
