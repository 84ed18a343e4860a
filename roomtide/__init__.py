"""roomtide: booking-risk analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
