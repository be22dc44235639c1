"""costlens: usage-cost analytics and forecasting expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the task, so executors
# need numpy, pandas and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
