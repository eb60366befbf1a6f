"""Operators for training-data pipelines. Worker code travels by value, so executors need no install."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
