"""encore: a Spark-first engine for item recommendations from play and click
behaviour (normalise, factorise, similar items, click re-ranking, per-user
views), expressed with DataFrame / SQL / Structured Streaming.
"""

import sys as _sys

try:  # Ship this package's functions inside task closures (no --py-files needed).
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
