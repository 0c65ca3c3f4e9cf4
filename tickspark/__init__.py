"""tickspark: Spark-native analytics for equity tick data and Monte Carlo risk.

Every public operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql`` expressions, so Catalyst plans (pushdown, pruning, partial
aggregation) and Spark schedules the work.  Sub-packages:

* ``sources``   - scans of tick / quote / close / job-history tables, file and message sinks
* ``functions`` - column expressions (trade filters, safe division, deterministic normals)
* ``operators`` - aggregations, bars, closes, returns, risk, job statistics, report text
* ``plans``     - end-to-end jobs composed from the operators
* ``streaming`` - message ingest and running VaR with Structured Streaming
"""

import sys as _sys

from tickspark.session import get_spark, shared_path

__all__ = ["get_spark", "shared_path"]

# The few functions that run in Python workers (batch generation, Gram
# partials) are closures over this package.  Pickling the package's objects
# by value lets those tasks run on executors where the package is not
# installed (no ``--py-files`` needed); everything else is JVM-side.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older pickler: ship the package with --py-files
    pass
