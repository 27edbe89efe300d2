"""noticeworks: procurement-notice extraction and maintenance on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
