"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

Functions that run inside tasks travel with the task, so executors need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
