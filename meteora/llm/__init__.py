"""Training-data operators: near-duplicate joins, packing, mixing, filters.

Functions that run in Python on executors are sent by value, so executors
need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
