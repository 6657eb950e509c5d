"""Analytics for a trading and coverage desk on Spark DataFrames, SQL and streams."""

import sys

from pyspark import cloudpickle

# functions sent to tasks travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
