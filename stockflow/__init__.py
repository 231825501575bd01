"""stockflow: stock metrics, forecasts and anomaly reports as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks that use them, so that
# executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
