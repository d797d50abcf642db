"""Training-data operators over whole corpora.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage ship to the executors by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
