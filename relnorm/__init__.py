"""relnorm — relational normalisation of nested archive metadata on Spark.

Everything is a ``DataFrame -> DataFrame`` function (``operators``), a
``Column -> Column`` function (``functions``), a reader (``sources``), a
writer (``sinks``) or a composed batch job (``plans``).  No driver-side
loops over data, no per-row Python UDF in a hot path.  Task functions and
data sources are shipped by value: executors need pyarrow and pandas, not
this package.
"""

import sys

from pyspark import cloudpickle

from relnorm.session import get_spark, checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
