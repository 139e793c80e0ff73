"""Operators that prepare text for language-model training. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions go to Python workers by value, so executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
