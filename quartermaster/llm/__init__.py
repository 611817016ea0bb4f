"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` derives the registered
``opN_*`` queries from them, and ``corpus_pipeline.py`` at the repository top
chains five of them.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
