"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it except ``__spark_entry__.py`` and
``corpus_pipeline.py``.  Task code is pickled by value, so executors need numpy, pyarrow
and sentencepiece but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
