"""Operators of a training-data pipeline over whole documents, pages and benchmarks.

The package is imported by the registered queries and by ``corpus_pipeline.py`` only. Code that runs in Python workers
is shipped by value, so executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
