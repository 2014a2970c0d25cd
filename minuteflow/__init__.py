"""Message streams kept as files in minute directories, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Tasks and streaming sources carry this package's functions with them, so it
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
