"""Operators and queries of a training-data pipeline."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package
