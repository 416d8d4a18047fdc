"""Document processing on Spark: relational operators as DataFrame columns,
Python only at provider boundaries."""

import sys

from pyspark import cloudpickle

# Functions handed to executors travel by value: workers need not be able to import the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
