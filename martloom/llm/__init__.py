"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Functions that run inside tasks travel by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
