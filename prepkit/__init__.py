"""prepkit: training-data preparation and evaluation as plain Spark DataFrame code."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
