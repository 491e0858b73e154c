"""Operators for preparing training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
