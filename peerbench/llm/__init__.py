"""Operators for preparing training text, and the queries that apply them.

Functions of this subpackage travel to the workers by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
