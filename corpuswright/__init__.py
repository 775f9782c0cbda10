"""Spark operators for building, auditing, featurising and evaluating labelled text corpora.

Operators take and return DataFrames and are lazy, apart from ``fit_*``, ``write_*``
and ``stage``, the exact group split (which first fits its two cut points) and the
similarity joins (which stage the merged texts).
"""

import sys

from pyspark import cloudpickle

# The few Arrow functions travel to the executors by value, so a job needs no
# copy of this package on the worker nodes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
