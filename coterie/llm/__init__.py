"""Operators for preparing training corpora, and the queries that apply them.

Functions of this package travel to the executors by value, so these need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
