"""vitrine: product-catalog analytics as Spark DataFrame jobs.

Python kernels (block similarity, encoders) are pickled by value so
executors need no installed copy of this package.
"""

import sys as _sys

try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__all__ = ["config"]
