"""Operators of a training-data pipeline. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel with their tasks, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
