"""tessera: Spark-native numeric statistics, word counting and weighted centre-based clustering."""

import sys

__version__ = "0.1.0"

# Ship the package's Python code (Arrow UDF kernels and their helpers) by value
# inside each task closure, so executors need not have it installed or on path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
