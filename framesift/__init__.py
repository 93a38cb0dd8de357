"""Spark-native operators for curating annotated data sets: plan as DataFrames, report, then apply.

Python code that runs on executors is shipped by value, so that a cluster needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
