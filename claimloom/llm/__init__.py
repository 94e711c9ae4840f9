"""Operators for training-data pipelines: dedup, mixing, packing, quality, formatting, scanning.

Functions of this package travel to the executors by value, so that executors need the third-party
libraries only and not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
