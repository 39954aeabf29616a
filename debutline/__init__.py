"""Spark operators for keeping, checking and modelling a table of share offerings."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
