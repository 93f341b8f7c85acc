"""Daily well-production analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
