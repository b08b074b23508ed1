"""Operators for building language-model training data.

Each module holds one operator; ``queries`` registers them over the test tables. Nothing
else in the package imports this one. Functions that run inside tasks are pickled by value,
so a cluster needs no copy of this package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
