"""Operators for preparing training text: one module for each, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors with their code: no installation is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
