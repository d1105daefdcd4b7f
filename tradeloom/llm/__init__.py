"""Operators for training-data pipelines; nothing else in the library imports them.

The functions that run inside tasks travel with the job (by value), so executors need
Python and its packages only, not a copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
