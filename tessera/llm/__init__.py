"""Operators for a training-data pipeline; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that
# a cluster needs no copy of the package on its nodes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
