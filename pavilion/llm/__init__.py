"""Operators of a training-data pipeline over documents and web pages. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks by value: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
