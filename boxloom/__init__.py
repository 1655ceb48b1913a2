"""Box-annotation analytics expressed as Spark DataFrame and streaming jobs."""

import sys

from pyspark import cloudpickle

# functions of this package travel to Python workers by value, so it need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
