"""tidewise: time-series preparation, profiling and forecasting as Spark jobs."""

import sys as _sys

__version__ = "0.1.0"

# Functions this package hands to Python workers (mapInPandas / applyInPandas)
# are pickled by value, so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must then be importable on workers
    pass
