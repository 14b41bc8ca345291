"""Spark-native table quality, modelling and scoring operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package that run on executors travel with their code, so the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
