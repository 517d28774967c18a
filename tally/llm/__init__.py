"""Operators for preparing training data at scale."""

import sys

from pyspark import cloudpickle

# Executors need no installation: the functions that they run travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
