"""Operators of a training-data pipeline. Nothing outside this folder imports it.

Functions of this package that run on executors are shipped by value, so that
executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
