"""Operators of a training-data pipeline.

Functions that run inside tasks are pickled by value, so executors need the
Python libraries only, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
