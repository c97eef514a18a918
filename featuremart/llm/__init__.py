"""Operators for large text collections used as training data."""

import sys

from pyspark import cloudpickle

# what runs in Python workers travels with the plan, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
