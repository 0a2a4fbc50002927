"""claimlens: health-insurance claims analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
