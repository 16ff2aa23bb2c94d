"""tidemark: incremental batch and stateful streaming operators for PySpark.

The package is a set of plain functions over DataFrames and streaming
DataFrames.  Functions and classes that run inside Python workers are shipped
by value, so a cluster needs no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
