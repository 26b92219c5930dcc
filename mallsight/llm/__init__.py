"""Operators of a training-data pipeline; nothing else in the library imports them.

Task functions of this package travel by value, so executors need numpy, pandas, pyarrow and
xxhash but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
