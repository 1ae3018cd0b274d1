"""Profiling, cleaning, statistics, session features and classifiers for grouped readings."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so the package is needed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
