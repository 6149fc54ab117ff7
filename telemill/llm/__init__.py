"""Operators for preparing training text.

Functions of this package that run in tasks travel with them by value, so that workers need not
have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
