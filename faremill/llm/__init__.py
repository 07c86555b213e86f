"""Operators for preparing text corpora, one module per operator.

Functions that run inside tasks are shipped by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
