"""shelfmark: library catalogue and circulation reports as Spark DataFrame plans.

Layers
------
sources    raw JSON-document tables (explicit schemas) and their flattened ``__t`` views
functions  Column helpers: JSON-array text, note extraction, names, prices, full-text search
plans      derived tables (pre-joined wide tables, one row per loan / item / code ...)
operators  the per-title / per-item templates and the parameterised reports

Functions that run in tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

from shelfmark.session import get_session, checkpoint_dir  # noqa: E402

__all__ = ["get_session", "checkpoint_dir"]
