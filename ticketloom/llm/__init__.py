"""Operators of a training-data pipeline over tables of texts.

Nothing outside this subpackage imports it. Its task functions are shipped to
the executors by value, so that workers need no path to this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
