"""Dataflow operators on PySpark DataFrames: sources, sinks, element-wise
operators, keyed and global aggregation, co-groups, windows and streams.

Every operator takes DataFrames and returns DataFrames, so they chain with
``df.transform`` and Catalyst sees one plan.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that a
# cluster needs no copy of the package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
