"""Operators for preparing training data: dedup, sharding, language, scoring, packing, mixing.

Functions of this package travel to the executors by value, so a cluster needs no copy
of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
