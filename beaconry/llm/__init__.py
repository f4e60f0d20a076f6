"""Operators for building training corpora."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: a cluster need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
