"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions of these modules run in executors' Python workers. They are pickled by value,
so the workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
