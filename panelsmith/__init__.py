"""panelsmith: panel preparation and group-wise imputation on Spark."""

import sys as _sys

__version__ = "0.1.0"

# Python functions shipped to executors (pandas UDFs, grouped-state
# functions) are pickled by value, so workers run them without the package
# being installed on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
