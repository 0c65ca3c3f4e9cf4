"""Operators for large training corpora (deduplication, filtering, search, packing, sharding).

Nothing outside this subpackage imports it.  Each operator is a
``DataFrame -> DataFrame`` function over named input columns; it selects what
it needs first, so further columns of the input - whatever their names - never
reach it.  Queries and their SQL are in :mod:`tickspark.llm.queries`.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Worker-side functions travel by value: executors need no installed package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
