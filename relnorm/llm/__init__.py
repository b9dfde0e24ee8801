"""Operators that a training-data pipeline needs, each its own module.

Task functions are shipped by value, so executors need numpy, pyarrow and the
tokenizers library but not this package.
"""

import sys

from pyspark import cloudpickle

import relnorm.session

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(relnorm.session)
