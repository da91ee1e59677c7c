"""Scorecard analytics for binary outcomes, expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few functions that run inside tasks travel with the job, so workers need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
