"""Corpus operators for training-data pipelines.

Functions of this package that run in Python workers are pickled by value, so the
operators need no copy of the package on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
