"""Operators of a training-data pipeline over documents and web pages."""

import sys

from pyspark import cloudpickle

# Code for tasks is sent with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
