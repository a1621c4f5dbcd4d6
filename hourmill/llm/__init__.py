"""Operators for building training data: deduplication, filtering, tokens, packing, search and formatting.

Functions of this subpackage travel to Python workers by value, so workers need
the public libraries only, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
