"""Operators for preparing training text, and their check queries."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
