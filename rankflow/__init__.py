"""Graph ranking, sorting and softmax training as plain Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
