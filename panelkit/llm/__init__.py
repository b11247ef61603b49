"""Operators of a training-data pipeline over ``documents`` and ``conversations``.

The task functions run in Python workers. They are pickled by value, so the
executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
