"""hirelens: job-market analytics on Spark."""

# Functions that run in Python workers (pandas UDF, mapInPandas,
# applyInPandasWithState) are pickled together with this package's code, so
# executors need no installed copy of it.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001  (older cloudpickle: fall back to an installed package)
    pass
