"""Operators of a training-data pipeline over documents and web pages; nothing else in the package imports this.

Functions that run in tasks are shipped by value, so executors need this package's libraries but not the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
