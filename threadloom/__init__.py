"""Spark-native analytics over threaded, user-generated text.

Every operator is a function from DataFrames to a DataFrame; nothing here runs
an action unless its docstring says so.
"""

import sys

from pyspark import cloudpickle

# Python workers receive the package's functions by value, so executors need no
# copy of the package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
