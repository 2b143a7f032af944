"""Operators of training-data pipelines: deduplication, tokens, scoring, archives.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this subpackage by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
