"""Operators for preparing language-model training data, and the queries that apply them.

Functions of this subpackage travel to executors by value, so that these need only the installed
libraries, not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
