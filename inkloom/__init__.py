"""Long documents to speakable text, and training data beside it, on Spark."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value: no copy of this package has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
