"""quarry: batch analytics operators expressed with the PySpark DataFrame and SQL APIs.

Sub-packages
------------
sources    readers, writers and catalog helpers (CSV, JSON, Parquet, tables)
operators  relational, profiling, semi-structured and regression operators
functions  column-level helpers (dates, banding, casts) and typed UDFs
plans      the named queries, their DuckDB oracle SQL and plan checks
streaming  running the stateless operators on a streaming frame
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# The few Python functions that run on executors (the pandas UDF and the
# JSON-array writer) are shipped by value, so Python workers do not need
# this package on their path (a driver that imports it from a checkout
# works without installing it on every executor).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
