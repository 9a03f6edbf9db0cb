"""Spark-native analytics for labelled event corpora and the detectors that score them."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers needn't have the package: functions sent to them carry their code along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
