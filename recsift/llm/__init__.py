"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

Task functions of its modules are sent to the executors by value, so a cluster needs the usual
libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
