"""Operators for preparing training text. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Tasks carry these functions with them: executors need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
