"""Operations of a large-scale training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
