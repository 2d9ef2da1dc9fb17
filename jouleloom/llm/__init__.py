"""Operators for training-data corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors as code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
