"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the tasks that run them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
