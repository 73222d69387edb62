"""quarry: named batch and streaming queries over Parquet tables, written
with the Spark DataFrame API, Spark SQL and Structured Streaming.

Entry points:

* ``quarry.catalog.queries()`` -- name -> callable(spark, sf_dir) -> DataFrame
* ``quarry.catalog.oracle_sql()`` -- name -> DuckDB SQL with the same result
* ``quarry.session.build_session()`` -- a local session for tests and bench
"""

__all__ = ["catalog", "session"]

import sys as _sys

# Ship this package's functions to Python workers by value: executors then
# need PySpark only, not this package on their import path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
