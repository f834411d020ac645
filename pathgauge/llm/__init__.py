"""Operators of a training-data pipeline over documents, pages and labels."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Code for Python workers travels with each job, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
