"""Lakehouse analytics as plain PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# helper functions travel inside the task, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
