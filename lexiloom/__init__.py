"""Corpus preparation with Spark DataFrames: dictionary flattening, markup-safe
column translation, sampled sentence pairs, payload filters and resumable runs."""

import sys

from pyspark import cloudpickle

# Executors get this package's Python functions with the tasks that use them,
# so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
