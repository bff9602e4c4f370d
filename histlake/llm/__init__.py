"""Operators of a training-data pipeline (see ``queries`` for the registered ones)."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
