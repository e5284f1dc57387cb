"""Operators of a training-data pipeline, each on plain Spark DataFrames.

Nothing outside this subpackage imports it. ``queries`` binds the operators
to the test tables; the modules below hold the operators themselves.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
