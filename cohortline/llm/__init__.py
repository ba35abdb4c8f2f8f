"""Operators for preparing training corpora. Nothing else in the library imports this folder.

Functions of this folder travel to the workers by value, so that the library
need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
