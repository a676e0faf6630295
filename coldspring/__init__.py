"""coldspring: cold-start aware recommendation analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run inside Arrow tasks are shipped with the task itself, so
# executors do not need this package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
