"""Near-duplicate detection for large text corpora on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors with their code, so the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
