"""Freight-cost anomaly detection and evidence retrieval as Spark DataFrame jobs."""

import sys

from pyspark.cloudpickle import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no copy of this
# package on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
