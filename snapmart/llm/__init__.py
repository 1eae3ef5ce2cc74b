"""Operators of a training-data pipeline over a table of documents (one module per operator).

Functions that run on executors are pickled by value, so workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
