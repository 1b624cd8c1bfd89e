"""lodestar: a Spark-native engine for linking, cleaning and auditing positioned labels."""

import sys

from pyspark import cloudpickle

# Workers may lack this package on their path, so functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
