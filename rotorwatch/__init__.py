"""rotorwatch: machine telemetry on Spark — batch and streaming.

Parse device messages, land a partitioned raw zone, compute right-closed
five-minute status windows, open and resolve alerts, validate and quarantine
readings, deduplicate per machine and minute, roll up daily reliability and
upsert it into a gold table; all as DataFrame / SQL / Structured Streaming jobs.
"""

import sys as _sys

try:  # ship this package's functions to Python workers by value
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark
    pass

__version__ = "0.1.0"
