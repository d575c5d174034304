"""Operators of a training-data pipeline.

Each module holds one operator; ``queries`` registers one query for each and
``common`` the few helpers they share.  Nothing else in the library imports
this package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
