"""Trip-record analytics on Spark: normalise drifting monthly feeds, audit them, compute indicators."""

import sys as _sys

try:  # Executors then need no copy of this package for the few Python-side helpers.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package with --py-files instead
    pass
