"""repflow: immune-repertoire analytics as Spark DataFrame operators."""

import sys as _sys

try:  # ship this package's Python helpers inside task closures (no --py-files needed)
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__version__ = "0.1.0"
