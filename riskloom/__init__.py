"""Credit-risk analytics as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the job, so the
# executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
