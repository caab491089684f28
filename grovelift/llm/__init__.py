"""Operators of a training-data pipeline, each as a Spark job over whole tables.

Functions that run in tasks are sent along by value, so executors need only the
third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
